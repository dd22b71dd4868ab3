"""Reverts in a stream of revisions: the state of a page is the places of the contents that it had."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupStateTimeout

OUT = "page_id bigint, rev_id bigint, rev_ord bigint, first_ord bigint, is_revert boolean"
_STATE = "contents array<string>, ords array<bigint>"


def _judge(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    seen = dict(zip(*state.get, strict=True)) if state.exists else {}
    rows = pd.concat(list(batches)).sort_values("rev_ord")
    first = []
    for sha1, size, ordinal in zip(rows["sha1"], rows["text_size"], rows["rev_ord"], strict=True):
        first.append(seen.setdefault(f"{sha1}|{size}", int(ordinal)))
    state.update((list(seen), list(seen.values())))
    out = rows[["page_id", "rev_id", "rev_ord"]].assign(first_ord=first)
    out["is_revert"] = out["first_ord"] < out["rev_ord"]
    yield out


def revert_stream(revs: DataFrame) -> DataFrame:
    """page_id, rev_id, rev_ord, first_ord, is_revert of each revision of a stream, as `with_first_seen` gives them, if a
    page's revisions come in their order from batch to batch."""
    slim = revs.selectExpr("cast(page_id as bigint) page_id", "cast(rev_id as bigint) rev_id", "cast(rev_ord as bigint) rev_ord", "sha1", "text_size")
    return slim.groupBy("page_id").applyInPandasWithState(_judge, OUT, _STATE, "append", GroupStateTimeout.NoTimeout)
