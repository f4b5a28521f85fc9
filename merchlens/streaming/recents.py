"""Capped list of every user's newest ratings, kept as streaming state."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from merchlens.constants import RECENT_LIST_CAP

STATE = "buffer ARRAY<STRUCT<ts: BIGINT, product_id: INT, score: DOUBLE>>"
OUTPUT = (
    "user_id INT, product_id INT, score DOUBLE, ts BIGINT, "
    "recents ARRAY<STRUCT<product_id: INT, score: DOUBLE>>"
)
COLUMNS = ["ts", "product_id", "score"]


def newest(pdf: pd.DataFrame, cap: int, by=()) -> pd.DataFrame:
    """The ``cap`` newest rows, per value of ``by`` if given."""
    ordered = pdf.sort_values(COLUMNS, ascending=False, kind="stable")
    return ordered.groupby(list(by), sort=False).head(cap) if by else ordered.head(cap)


def trim_batches(ratings: DataFrame, cap: int = RECENT_LIST_CAP) -> DataFrame:
    """Keep the newest ``cap`` rows of a user in every chunk before the shuffle.

    Older rows of the chunk could never enter the list, so a very busy user sends a
    few rows per chunk instead of all.
    """

    def trim(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in chunks:
            yield newest(chunk, cap, by=["user_id"])

    columns = ratings.select("user_id", "product_id", "score", "ts")
    return columns.mapInPandas(trim, columns.schema)


def recent_lists(ratings: DataFrame, cap: int = RECENT_LIST_CAP) -> DataFrame:
    """Stream of ``(user, newest rating of the batch, list)``, one row per user and batch.

    The list is ordered by time, then product, then score, all newest or highest first,
    so its content does not depend on the order of arrival.
    """

    def push(key, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept = [tuple(row) for row in state.get[0]] if state.exists else []
        latest = None
        for chunk in chunks:
            rows = [
                (int(ts), int(product), float(score))
                for ts, product, score in newest(chunk, cap)[COLUMNS].itertuples(index=False)
            ]
            if not rows:
                continue
            latest = rows[0] if latest is None else max(latest, rows[0])
            kept = sorted(kept + rows, reverse=True)[:cap]
        if latest is None:
            return
        state.update((kept,))
        ts, product, score = latest
        recents = [{"product_id": p, "score": s} for _, p, s in kept]
        yield pd.DataFrame(
            {
                "user_id": [key[0]],
                "product_id": [product],
                "score": [score],
                "ts": [ts],
                "recents": [recents],
            }
        )

    return (
        trim_batches(ratings, cap)
        .groupBy("user_id")
        .applyInPandasWithState(push, OUTPUT, STATE, "update", GroupStateTimeout.NoTimeout)
    )
