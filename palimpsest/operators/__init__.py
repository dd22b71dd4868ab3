"""DataFrame -> DataFrame operators over revisions, edits and preference rows."""
