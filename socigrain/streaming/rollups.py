"""Rollups kept up while posts arrive: inbound reactions per post and measures per week.

Both equal their batch forms over all posts that have arrived.  A batch is aggregated before it meets
the state, so a post or week that draws a third of all reactions is one row per batch there.  Posts must
not arrive twice: put ``incremental.new_posts`` in front.  A reaction may arrive before its post.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.posts import reaction_refs
from ..session import cut, drop_cut
from .folded import FoldedTable, drain

KINDS = ("repost", "quote", "reply")
COUNTS = [f"in_{k}_cnt" for k in KINDS]
#: Number of posts, then the flags that are counted.
OWN = {
    "total_out_cnt": "", "original_cnt": "is_original", "out_repost_cnt": "is_repost",
    "out_reply_cnt": "is_reply", "out_quote_cnt": "is_quote",
}
FAVOURITES = {
    "in_original_favourite_cnt": "original_favourite_cnt", "in_repost_favourite_cnt": "repost_favourite_cnt",
    "in_quote_favourite_cnt": "quote_favourite_cnt",
}
#: Columns of flat posts that the rollups read.
NEEDED = [
    "id", "user_id", "week_name", "created_at", "is_original", "is_repost", "is_reply", "is_quote",
    *FAVOURITES.values(), "repost_of_id", "quote_of_id", "reply_to_id", "repost_delay_sec", "quote_delay_sec",
]


def inbound_sums(posts: DataFrame) -> DataFrame:
    """(id, counts, delay sums and numbers of delays) of the posts that ``posts`` react to."""
    refs = reaction_refs(posts)
    values = [F.count_if(F.col("kind") == k).alias(f"in_{k}_cnt") for k in KINDS]
    for k in ("repost", "quote"):
        delay = F.when(F.col("kind") == k, F.col("delay"))
        values += [F.coalesce(F.sum(delay), F.lit(0)).cast("bigint").alias(f"{k}_delay"), F.count(delay).alias(f"{k}_delays")]
    return refs.groupBy("id").agg(*values)


def _with_means(sums: DataFrame) -> DataFrame:
    return sums.withColumns({f"in_{k}_delay_sec": F.try_divide(f"{k}_delay", f"{k}_delays") for k in ("repost", "quote")})


class InboundStream:
    """Counts and mean delays of the reactions to each post."""

    def __init__(self, spark: SparkSession, root: str, fold_every: int = 16):
        values = [*COUNTS, *[f"{k}_{c}" for k in ("repost", "quote") for c in ("delay", "delays")]]
        schema = "id bigint, " + ", ".join(f"{c} bigint" for c in values)
        self.root = root
        self.sums = FoldedTable(spark, f"{root}/inbound", schema, dict.fromkeys(values, "sum"), fold_every)

    def accept(self, posts: DataFrame, batch: int) -> None:
        self.sums.write(batch, inbound_sums(posts))

    def run(self, stream: DataFrame) -> int:
        """Take in what has arrived; returns the last batch committed."""
        return drain(stream, self.accept, f"{self.root}/progress")

    def current(self, last: int, only: DataFrame | None = None) -> DataFrame:
        """The columns of ``posts.inbound_reactions`` after batch ``last``."""
        return _with_means(self.sums.read(last, only)).select(
            "id", "in_repost_cnt", "in_repost_delay_sec", "in_quote_cnt", "in_quote_delay_sec", "in_reply_cnt"
        )


class WeekStream:
    """The week rollup of posts with their inbound reactions.

    What a post draws counts in the post's own week, and its mean delays aren't sums.  So a batch looks up
    the posts it adds or reacts to, before and after, and adds the difference to their weeks.
    """

    def __init__(self, spark: SparkSession, root: str, fold_every: int = 16):
        self.root = root
        sums = [*OWN, *FAVOURITES, *[f"{k}_{c}" for k in ("repost", "quote") for c in ("delay", "delays")]]
        drawn = {c: "bigint" for c in COUNTS} | {f"{k}_means": "double" for k in ("repost", "quote")}

        def table(name: str, schema: str, merge: dict[str, str]) -> FoldedTable:
            return FoldedTable(spark, f"{root}/{name}", schema, merge, fold_every)

        self.own = table("own", "week_name string, " + ", ".join(f"{c} bigint" for c in sums) + ", first_post timestamp",
                         dict.fromkeys(sums, "sum") | {"first_post": "min"})
        self.drawn = table("drawn", "week_name string, " + ", ".join(f"{c} {t}" for c, t in drawn.items()), dict.fromkeys(drawn, "sum"))
        self.users = table("users", "week_name string, user_id bigint", {})
        self.weeks = table("weeks", "id bigint, week_name string", {"week_name": "min"})
        self.inbound = InboundStream(spark, root, fold_every)

    def _drawn(self, last: int, ids: DataFrame, sign: int) -> DataFrame:
        """What the known posts among ``ids`` add to their weeks after batch ``last``, times ``sign``."""
        joined = self.weeks.read(last, ids).join(self.inbound.current(last, ids), "id", "left")
        measured = {c: c for c in COUNTS} | {f"{k}_means": f"in_{k}_delay_sec" for k in ("repost", "quote")}
        return joined.select("week_name", *[(F.coalesce(c, F.lit(0)) * sign).alias(name) for name, c in measured.items()])

    def accept(self, posts: DataFrame, batch: int) -> None:
        rows = cut(posts.select(*NEEDED))
        own = [(F.count_if(F.col(c)) if c else F.count(F.lit(1))).alias(name) for name, c in OWN.items()]
        own += [F.coalesce(F.sum(c), F.lit(0)).alias(name) for name, c in FAVOURITES.items()]
        for k in ("repost", "quote"):
            own += [F.coalesce(F.sum(f"{k}_delay_sec"), F.lit(0)).alias(f"{k}_delay"), F.count(f"{k}_delay_sec").alias(f"{k}_delays")]
        self.own.write(batch, rows.groupBy("week_name").agg(*own, F.min("created_at").alias("first_post")))
        self.users.write(batch, rows)
        self.weeks.write(batch, rows.select("id", "week_name"))
        self.inbound.accept(rows, batch)
        touched = cut(rows.select("id").union(reaction_refs(rows).select("id")).distinct())
        self.drawn.write(batch, self._drawn(batch, touched, 1).unionByName(self._drawn(batch - 1, touched, -1)))
        drop_cut(touched)
        drop_cut(rows)

    def run(self, stream: DataFrame) -> int:
        """Take in what has arrived; returns the last batch committed."""
        return drain(stream, self.accept, f"{self.root}/progress")

    def current(self, last: int) -> DataFrame:
        """The columns of ``rollups.week_rollup`` after batch ``last``."""
        users = self.users.read(last).groupBy("week_name").agg(F.count(F.lit(1)).alias("user_cnt"))
        joined = self.own.read(last).join(self.drawn.read(last), "week_name").join(users, "week_name")
        return joined.select(
            "week_name", *OWN, *COUNTS, *FAVOURITES,
            F.expr("in_repost_cnt + in_quote_cnt + in_reply_cnt").alias("total_in_cnt"), "user_cnt",
            *[F.try_divide(f"{k}_delay", f"{k}_delays").alias(f"out_{k}_delay_sec") for k in ("repost", "quote")],
            *[F.try_divide(f"{k}_means", "total_out_cnt").alias(f"in_{k}_delay_sec") for k in ("repost", "quote")],
            "first_post",
        )
