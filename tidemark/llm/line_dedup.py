"""Line dedup: a suffix array over line ids by distributed prefix doubling.

Every line of a document gets an id (two 64-bit hashes of its bytes). The
suffix at a line is ordered by the ids from there to the document's end. Rank
0 orders single lines; round k pairs a suffix's rank with the rank 2^k lines
further on and ranks the pairs by one range sort, which orders suffixes by
their first 2^(k+1) lines. A suffix whose prefix is unique is placed for good
and leaves the rounds, so they only carry repeated lines.

Doubling stops at depth ``min_lines``: suffixes of equal rank then are the
longest-common-prefix intervals of at least ``min_lines``; a deeper order
cannot change which lines belong to one. In each interval the first copy in
(doc_id, line) order stays and all later ones are deleted; overlapping and
adjacent deletions join to maximal repeated runs. With ``over_words``, later
copies of shorter runs go as well when they hold more words than that: the
depths below ``min_lines`` are passed one by one, and their intervals count too.

DataFrame functions only. Repeats are counted with map-side combine before any
join, so a very frequent line is one row a task; joins on hot ids can be split
by adaptive execution. A document's own lines are the only rows gathered.

Defined cases: null text stays null (0 lines); empty text is one empty line;
lines end at ``\\n`` only; rows with equal ``doc_id`` and text are one document
(all get the same result, none deletes from the other); rows with equal
``doc_id`` and different text are ordered by a hash of the text; null
``doc_id`` sorts first; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import free, written

MIN_LINES = 3  # a repeated run has three lines or more, as in three-sentence dedup of web corpora
OVER_WORDS = 50  # shorter runs of more words than this are passages too


def _ranked(counted: DataFrame, keys: list[str]) -> DataFrame:
    """Order-preserving ranks (``to``) of the distinct repeated keys: a range
    sort, then ids that increase with (partition, row)."""
    return written(counted.where("n > 1").select(*keys).orderBy(*keys).withColumn("to", F.monotonically_increasing_id()),
                   "op1-ranks")


def repeated_starts(docs: DataFrame, min_lines: int = MIN_LINES, over_words: int | None = None) -> DataFrame:
    """Suffixes that share ``min_lines`` lines, or fewer lines of more than
    ``over_words`` words, with an earlier one: ``doc_id``, ``th`` (hash of the
    text), ``pos`` (line, from 0), ``len`` (lines)."""
    place = ["doc_id", "th", "pos"]
    counted = [] if over_words is None else ["own", "words"]  # words of the line, and of the prefix of the present depth
    lines = (docs.where("text is not null")
             .select("doc_id", F.xxhash64("text").alias("th"), F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
             .select(*place, F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"),
                     *[F.regexp_count("line", F.lit(r"[^\x20\x09-\x0D]+")).alias(c) for c in counted]))
    lines = written(lines, "op1-lines")
    keys = ["h1", "h2"]
    ranks = _ranked(lines.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), keys)
    state = written(lines.join(ranks, keys).select(*place, *counted, F.col("to").alias("rank")), "op1-state")

    def later(state: DataFrame, depth: int) -> DataFrame:
        first = state.groupBy("rank").agg(F.min(F.struct(*place)).alias("first"))
        return (state.join(first, "rank").where(~F.struct(*place).eqNullSafe(F.col("first")))
                .select(*place, F.lit(depth).alias("len")).distinct())

    depth = 1
    keys = ["rank", "next"]
    short = []
    while depth < min_lines:
        step = min(depth, min_lines - depth)
        if counted:
            short.append(later(state.where(F.col("words") > over_words), depth))
            step = 1
        within = Window.partitionBy("doc_id", "th").orderBy("pos").rangeBetween(step, step)
        pairs = state.withColumn("next", F.max("rank").over(within))
        if counted:
            pairs = pairs.withColumn("words", F.col("own") + F.max("words").over(within))
        pairs = written(pairs.where("next is not null"), "op1-pairs")
        ranks = _ranked(pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), keys)
        state = written(pairs.join(ranks, keys).select(*place, *counted, F.col("to").alias("rank")), "op1-state")
        depth += step
    starts = later(state, min_lines)
    for more in short:
        starts = starts.unionByName(more)
    return starts


def repeated_runs(docs: DataFrame, min_lines: int = MIN_LINES, over_words: int | None = None) -> DataFrame:
    """Maximal runs to delete, one row per document that has any: ``doc_id``,
    ``th``, ``runs`` (ascending array of ``s``, ``e``: first line, line after)."""
    starts = repeated_starts(docs, min_lines, over_words).withColumn("to", F.col("pos") + F.col("len"))
    doc = Window.partitionBy("doc_id", "th").orderBy("pos")
    reach = F.max("to").over(doc.rowsBetween(Window.unboundedPreceding, -1))
    runs = (starts.withColumn("gap", (F.col("pos") > reach).cast("int"))
            .withColumn("run", F.sum(F.coalesce("gap", F.lit(0))).over(doc))
            .groupBy("doc_id", "th", "run").agg(F.min("pos").alias("s"), F.max("to").alias("e")))
    return runs.groupBy("doc_id", "th").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("runs"))


def line_dedup(docs: DataFrame, min_lines: int = MIN_LINES, over_words: int | None = None) -> DataFrame:
    """``docs`` with later copies of repeated line runs deleted from ``text``,
    and three more columns: ``n_lines``, ``n_removed``, ``n_runs`` (long; an
    underscore is added to a name that ``docs`` has already)."""
    runs = written(repeated_runs(docs, min_lines, over_words), "op1-runs")
    key, th, got, own = (free(docs, c) for c in ("_key", "_th", "_runs", "_own"))
    runs = runs.select(F.col("doc_id").alias(key), F.col("th").alias(th), F.col("runs").alias(got))
    # one plan at every size: the affected documents grow with the table, so both sides are dealt by key
    joined = docs.withColumn(own, F.xxhash64("text")).join(
        runs.hint("merge"), F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(own) == F.col(th)), "left")
    lines, r = F.split("text", "\n", -1), F.col(got)
    # kept lines: the slices between the runs
    none = F.array().cast("array<string>")
    before = F.flatten(F.transform(r, lambda x, i: F.slice(
        lines, F.when(i == 0, 0).otherwise(F.element_at(r, F.greatest(i, F.lit(1)))["e"]) + 1,
        x["s"] - F.when(i == 0, 0).otherwise(F.element_at(r, F.greatest(i, F.lit(1)))["e"]))))
    last = F.element_at(r, -1)["e"]
    kept = F.concat(before, F.when(last < F.size(lines), F.slice(lines, last + 1, F.size(lines) - last)).otherwise(none))
    text = F.when(r.isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    removed = F.coalesce(F.aggregate(r, F.lit(0).cast("long"), lambda a, x: a + (x["e"] - x["s"])), F.lit(0).cast("long"))
    size = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long")
    return joined.select(*[(text.alias(c) if c == "text" else F.col(c)) for c in docs.columns],
                         size.alias(free(docs, "n_lines")), removed.alias(free(docs, "n_removed")),
                         F.coalesce(F.size(r), F.lit(0)).cast("long").alias(free(docs, "n_runs")))
