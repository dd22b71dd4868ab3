"""End-to-end plans: retained diffs of featured articles, neutrality edits and their diffs, and the dataset of either."""
