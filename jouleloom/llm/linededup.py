"""Repeated line runs by a distributed suffix array over the line ids of all documents.

Lines are the parts between line feeds. The corpus is one sequence of line ids, document after document,
and a run never crosses a document's end. Prefix doubling gives every position a rank such that ranks order
the suffixes by their first 1, 2, 4, ... lines and positions share a rank exactly if these lines agree. A
rank shared by several positions is an interval of the suffix array with that common prefix. Positions
whose block occurs once leave at once, so each round handles what still repeats. Inside the intervals the
exact common prefix with an earlier position is found by binary descent over the ranks. Of every maximal
run that occurs earlier, long enough in characters, the later copies are deleted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jouleloom.llm.common import OWN, row_key
from jouleloom.session import written

POSITION = ["doc", "line"]
NODE = ["node_doc", "node_line", "length"]


def line_table(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per line of `docs` (columns order, one, two, text): its number, two hashes and its characters.

    Two hash functions name a line by 128 bits; a null text has no line, an empty one has one empty line.
    """
    lines = docs.select("order", "one", "two", F.posexplode(F.split(F.col(text), "\\n", -1)).alias("line", "of"))
    return lines.select(
        "order", "one", "two", F.col("line").cast("bigint").alias("line"), F.xxhash64(F.lit(1), "of").alias("h1"),
        F.xxhash64(F.lit(2), "of").alias("h2"), F.length("of").cast("bigint").alias("chars"),
    )


def ranked(keys: DataFrame, by: list[str], out: str) -> DataFrame:
    """Distinct `keys` with a long in `out` that orders them by `by`: sorted ranges, numbered where they lie.

    The numbers have gaps between ranges. They are written, so that a lost executor cannot renumber.
    """
    placed = keys.repartitionByRange(*by).sortWithinPartitions(*by)
    return written(placed.withColumn(out, F.monotonically_increasing_id()), "suffix-ranks")


def first(columns: list[str]) -> Column:
    return F.min(F.struct(*columns))


def repeated(blocks: DataFrame, by: list[str]) -> DataFrame:
    """`blocks` (POSITION, `by`) that occur more than once, with the rank of what they hold and its first position."""
    classes = blocks.groupBy(*by).agg(F.count(F.lit(1)).alias(OWN + "n"), first(POSITION).alias("at"))
    ranks = ranked(classes.where(F.col(OWN + "n") > 1).drop(OWN + "n"), by, "rank")
    return blocks.join(ranks, by).select(*[c for c in blocks.columns if c not in by], "rank", F.col("at.doc").alias("first_doc"), F.col("at.line").alias("first_line"))


def doubled(level: DataFrame, step: int) -> DataFrame:
    """The level for blocks of 2 * `step` lines from that for `step` lines."""
    after = level.select("doc", (F.col("line") - step).alias("line"), F.col("rank").alias("rank2"))
    pairs = level.select(*POSITION, F.col("rank").alias("rank1")).join(after, POSITION)
    return written(repeated(pairs, ["rank1", "rank2"]), "suffix-level")


def suffix_levels(lines: DataFrame) -> list[DataFrame]:
    """Ranks of all positions whose block of 1, 2, 4, ... lines occurs again, until none does.

    `lines` has POSITION, h1 and h2. Level k orders the suffixes by their first 2^k lines; the last one is
    the suffix array of all that repeats.
    """
    levels = [written(repeated(lines.select(*POSITION, "h1", "h2"), ["h1", "h2"]), "suffix-level")]
    while not levels[-1].isEmpty():
        levels.append(doubled(levels[-1], 2 ** (len(levels) - 1)))
    return levels[:-1]


def longest_earlier(levels: list[DataFrame]) -> DataFrame:
    """(doc, line, length): how many lines from a position on also occur from some earlier position on.

    A position starts in its interval at the highest level where it is not the first. Of a set of positions
    that share `length` lines, those that are first in a wider interval, and the first of all, stand for
    the rest. Step s asks which of them agree in 2^s lines more: these move on with the first of them as
    their source, the others stay. A set keeps at most one source, so rows at most double.
    """
    later = F.struct(*POSITION) > F.struct("first_doc", "first_line")
    members = []
    for k, level in enumerate(levels):
        own = level.where(later)
        if k + 1 < len(levels):
            higher = levels[k + 1].where(later).select(*POSITION)
            own = own.join(higher, POSITION, "left_anti")
        active = own.select(F.col("first_doc").alias("node_doc"), F.col("first_line").alias("node_line"), F.lit(2**k).cast("bigint").alias("length"), *POSITION)
        members.append(active.withColumn("level", F.lit(k)))
    if not members:
        raise ValueError("no level")
    active = written(reduce(DataFrame.union, members), "suffix-active")
    sources = active.select(*NODE, "level").distinct()
    state = active.withColumn("active", F.lit(True)).unionByName(
        sources.select(*NODE, F.col("node_doc").alias("doc"), F.col("node_line").alias("line"), "level", F.lit(False).alias("active"))
    )
    for s in range(len(levels) - 2, -1, -1):
        ready = F.col("level") > s
        more = levels[s].select("doc", (F.col("line")).alias("reach"), "rank")
        asked = written(state.where(ready).withColumn("reach", F.col("line") + F.col("length")).join(more, ["doc", "reach"], "left").drop("reach"), "suffix-asked")
        sets = asked.where("rank IS NOT NULL").groupBy(*NODE, "level", "rank").agg(first(POSITION).alias("at"), F.count(F.lit(1)).alias("n"))
        sets = written(sets.where("n > 1").drop("n"), "suffix-sets")
        met = asked.join(sets.drop("level"), [*NODE, "rank"], "left")
        moves = F.col("active") & F.col("at").isNotNull() & (F.struct(*POSITION) > F.struct("at.doc", "at.line"))
        moves = F.coalesce(moves, F.lit(False))
        met = met.select(
            F.when(moves, F.col("at.doc")).otherwise(F.col("node_doc")).alias("node_doc"),
            F.when(moves, F.col("at.line")).otherwise(F.col("node_line")).alias("node_line"),
            (F.col("length") + F.when(moves, 2**s).otherwise(0)).alias("length"),
            *POSITION, "level", "active",
        )
        at = F.col("at.doc"), F.col("at.line")
        carried = sets.select(
            at[0].alias("node_doc"), at[1].alias("node_line"), (F.col("length") + 2**s).alias("length"), at[0].alias("doc"), at[1].alias("line"), "level", F.lit(False).alias("active"),
        )
        state = written(met.unionByName(carried).unionByName(state.where(~ready)), "suffix-state")
    return state.where("active").select(*POSITION, "length")


def later_runs(docs: DataFrame, min_chars: int, text: str = "text") -> DataFrame:
    """(one, two, start, stop) of the line runs [start, stop) of each document that occur earlier in the corpus.

    `docs` has order, one, two and the text. Earlier means: in a document before it by (order, one, two), or
    above it in the same one. Runs of fewer than `min_chars` characters, line feeds left out, don't count;
    overlapping and adjacent runs are merged.
    """
    lines = written(line_table(docs, text), "lines")
    twice = written(lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "lines-twice")
    kept = written(lines.join(twice, ["h1", "h2"]), "lines-repeated")
    numbers = ranked(kept.select("order", "one", "two").distinct(), ["order", "one", "two"], "doc").drop("order")
    kept = kept.join(numbers, ["one", "two"]).dropDuplicates(["one", "two", "line"])  # of rows given twice
    kept = written(kept.select(*POSITION, "h1", "h2", "chars"), "lines-placed")
    levels = suffix_levels(kept)
    if not levels:
        return docs.sparkSession.range(0).selectExpr("id AS one", "id AS two", "CAST(array() AS array<struct<start:bigint,stop:bigint>>) AS runs")
    # All lines of a run repeat, so sums over the repeated lines of a document give its characters.
    so_far = F.sum("chars").over(Window.partitionBy("doc").orderBy("line"))
    sums = kept.select(*POSITION, (so_far - F.col("chars")).alias("before"), so_far.alias("until"))
    runs = longest_earlier(levels).withColumn("last", F.col("line") + F.col("length") - 1)
    runs = runs.join(sums.drop("until"), POSITION).join(sums.select("doc", F.col("line").alias("last"), "until"), ["doc", "last"])
    runs = runs.where(F.col("until") - F.col("before") >= min_chars).select("doc", F.col("line").alias("start"), (F.col("last") + 1).alias("stop"))
    # Overlapping and adjacent runs become one: a new one begins where no earlier one reaches.
    along = Window.partitionBy("doc").orderBy("start", "stop")
    reach = F.max("stop").over(along.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(F.col("start") <= F.col("reach"), 0).otherwise(1)
    islands = runs.withColumn("reach", reach).withColumn("island", F.sum(begins).over(along))
    merged = islands.groupBy("doc", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    merged = merged.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("runs"))
    return merged.join(numbers, "doc").select("one", "two", "runs")


def dedup_lines(df: DataFrame, min_chars: int = 100, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """`df` with the later copies of repeated line runs deleted from `text`, and what was deleted.

    Adds n_lines (lines before), n_deleted and deleted (an array of line runs [start, stop), from 0); input
    columns of these names are replaced. Documents are in the order of `id_column`, null first, those of one
    id in the order of hashes of their text. Rows that agree in id and text are one document given several
    times: they lose the same lines, and none for the sake of each other. A null text stays null and has no
    line; an empty text has one line, too short to be deleted. A document that loses all lines keeps an
    empty text. Empty tables give empty ones.
    """
    one, two, out = OWN + "one", OWN + "two", ("n_lines", "n_deleted", "deleted")
    df = df.drop(*out)
    keyed = df.withColumns({one: row_key(id_column, text, salt=1), two: row_key(id_column, text, salt=2)})
    docs = keyed.select(F.col(id_column).alias("order"), F.col(one).alias("one"), F.col(two).alias("two"), F.col(text).alias("text"))
    runs = later_runs(docs, min_chars).select(F.col("one").alias(one), F.col("two").alias(two), F.col("runs").alias("deleted"))
    joined = keyed.join(runs.hint("shuffle_hash"), [one, two], "left").drop(one, two)
    lines, number = F.split(F.col(text), "\n", -1), F.size(F.split(F.col(text), "\n", -1)).cast("bigint")
    starts = F.concat(F.array(F.lit(0).cast("bigint")), F.transform("deleted", lambda r: r["stop"]))
    stops = F.concat(F.transform("deleted", lambda r: r["start"]), F.array(number))
    between = F.arrays_zip(starts.alias("start"), stops.alias("stop"))
    left = F.flatten(F.transform(between, lambda b: F.slice(lines, (b["start"] + 1).cast("int"), (b["stop"] - b["start"]).cast("int"))))
    lost = F.aggregate("deleted", F.lit(0).cast("bigint"), lambda n, r: n + r["stop"] - r["start"])
    return joined.withColumns(
        {
            "n_lines": F.when(F.col(text).isNull(), F.lit(0)).otherwise(number).cast("bigint"),
            "n_deleted": F.coalesce(lost, F.lit(0).cast("bigint")),
            text: F.when(F.col("deleted").isNull(), F.col(text)).otherwise(F.concat_ws("\n", left)),
        }
    )
