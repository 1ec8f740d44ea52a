"""K-d tree sharding: equal bytes per shard, near metadata together.

The rows are split again and again along the metadata dimension in which the current
node is widest, at the distributed weighted median, until a leaf has the target bytes.
For a number of shards that is no power of two the cut is at the share of the bytes
that the left child's shards are due.

A dimension's values are laid on a grid of 2^19 cells between its smallest and largest
value; null is the cell before the first. Strings count by their rank among the column's distinct
values, so a prefix that all of them share costs nothing. Rows of one cell are told apart by
a hash of id and text, and equal ones by a hash of the row's number, so a value, or
a row repeated, that holds a third of all rows is cut as finely as any other. The cut is found by histograms: every pass counts
bytes in up to 4,096 intervals per node, for all nodes of a level at once, and goes on
inside the one interval that holds the median, until that holds one row. The driver sees
one row per node.

Null texts have no bytes besides the overhead. Which of several equal rows goes to
which shard depends on how the table is read; they are equal, so it shows in nothing else. An empty table
gives an empty result. Columns other than id, text and dimensions take no part.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from negsift.llm.frames import numbered, small_table
from negsift.operators.skew import hottest, lookup
from negsift.session import stored

CELLS = 1 << 19
TIES = 1 << 43
COPIES = 1 << 20  # the part of the ties that tells equal rows apart
BINS = 4096
OVERHEAD = 16
_SPLITS = "node int, dim int, cut long, step int"


@dataclass(frozen=True)
class Grid:
    """How values become cells: the ends of each dimension, and the ranks of those that hold strings."""

    ends: dict
    ranks: dict[str, DataFrame]


def position(name: str, kind: str) -> Column:
    """A dimension's value as a number; strings stay what they are until :func:`ranked`."""
    if kind in ("string", "binary"):
        return F.col(name)
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def numbers(docs: DataFrame, dims: list[str], id_col: str, text_col: str) -> dict[str, Column]:
    """What sharding works on, a few values per row."""
    kinds = dict(docs.dtypes)
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = F.pmod(F.xxhash64(F.col(id_col), text), F.lit(TIES // COPIES))
    copy = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(COPIES))
    return {
        "_size": (F.octet_length(text) + OVERHEAD).cast("long"),
        "_crc": F.crc32(F.encode(text, "UTF-8")),
        "_tie": own * COPIES + copy,
        **{f"_v{i}": position(c, kinds[c]) for i, c in enumerate(dims)},
    }


def value_ranks(rows: DataFrame, column: str) -> DataFrame:
    """The distinct values of ``column`` with ``many`` (rows) and ``_rank``, from 0 without gaps.

    The values are sorted in ranges, one per task, and numbered within theirs; the driver sees the size of each range.
    """
    counts = rows.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("many"))
    in_order = stored(counts.orderBy(column).withColumn("_at", F.monotonically_increasing_id()), "values")
    sizes = in_order.groupBy(F.shiftright("_at", 33).alias("range")).count().collect()
    starts, before = [], 0
    for r in sorted(sizes):
        starts.append({"range": r["range"], "start": before})
        before += r["count"]
    table = F.broadcast(small_table(rows.sparkSession, starts, "range long, start long"))
    met = in_order.join(table, F.shiftright("_at", 33) == F.col("range"))
    place = F.col("start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return met.select(column, "many", place.cast("double").alias("_rank"))


def ranked(rows: DataFrame, ranks: dict[str, DataFrame]) -> DataFrame:
    """``rows`` with ranks in place of strings. Frequent values meet theirs in a broadcast of at most 1,000."""
    for column, table in ranks.items():
        hot = hottest(table, "many").drop("many")
        met = lookup(rows, table.drop("many"), [column], hot, F.col("_tie").cast(dict(rows.dtypes)[column]))
        rows = met.drop("found", column).withColumnRenamed("_rank", column)
    return rows


def on_grid(rows: DataFrame, ends: dict) -> DataFrame:
    """``rows`` with ``_keys``: per dimension the cell and, within it, the tie-breaking hash."""

    def key(i: int) -> Column:
        lo, hi = ends[f"lo{i}"], ends[f"hi{i}"]
        if lo is None or lo == hi:
            cell = F.when(F.col(f"_v{i}").isNull(), 0).otherwise(1)
        else:
            # Halves: the distance of two doubles may be too large for one.
            share = (F.col(f"_v{i}") / 2 - lo / 2) / (hi / 2 - lo / 2)
            cell = F.coalesce(F.floor(share * (CELLS - 2)) + 1, F.lit(0))
        return cell.cast("long") * TIES + F.pmod(F.col("_tie"), F.lit(TIES))

    return rows.withColumn("_keys", F.array(*[key(i) for i in range(len(ends) // 2)]))


def assign(rows: DataFrame, levels: list[list[dict]]) -> DataFrame:
    """``rows`` with ``_node``, by the splits of each level; one row per node is broadcast."""
    out = rows.withColumn("_node", (F.col("_tie") * 0).cast("int"))  # the root; a literal would leave no key to join by
    for level in levels:
        splits = small_table(rows.sparkSession, level, _SPLITS)
        out = out.join(F.broadcast(splits), F.col("_node") == F.col("node"), "left")
        right = F.get("_keys", F.col("dim")) >= F.col("cut")
        out = out.withColumn("_node", F.col("_node") + F.when(right, F.col("step")).otherwise(0)).drop("node", "dim", "cut", "step")
    return out


def _medians(rows: DataFrame, wanted: list[dict]) -> list[dict]:
    """The cut of each node: ``node, dim, lo, hi`` (of its keys), ``goal`` (bytes to the left) and ``step``."""
    spark, done = rows.sparkSession, []
    for w in wanted:
        w["before"] = 0
    while wanted:
        bins = max(16, min(BINS, (1 << 20) // len(wanted)))
        for w in wanted:
            w["width"] = max(1, -(-(w["hi"] - w["lo"] + 1) // bins))
        search = small_table(
            spark, [{k: w[k] for k in ("node", "dim", "lo", "hi", "width", "before", "goal")} for w in wanted],
            "node int, dim int, lo long, hi long, width long, before long, goal double",
        )
        near = rows.join(F.broadcast(search), F.col("_node") == F.col("node"))
        near = near.withColumn("_key", F.get("_keys", F.col("dim"))).filter("_key between lo and hi")
        counts = near.groupBy("node", "before", "goal", F.expr("(_key - lo) div width").alias("bin")).agg(
            F.sum("_size").alias("bytes"), F.count(F.lit(1)).alias("many")
        )
        up_to = F.col("before") + F.sum("bytes").over(W.partitionBy("node").orderBy("bin"))
        first = F.min_by(F.struct("bin", "up_to", "bytes", "many"), "bin")
        at = {
            r["node"]: r["at"]
            for r in counts.withColumn("up_to", up_to).filter("up_to >= goal").groupBy("node").agg(first.alias("at")).collect()
        }
        going = []
        for w in wanted:
            found, lo, width = at.get(w["node"]), w["lo"], w["width"]
            if found is None:  # rounding of the goal: everything lies to the left
                done.append(w | {"cut": w["hi"] + 1})
                continue
            start = lo + found["bin"] * width
            left, right = found["up_to"] - found["bytes"], found["up_to"]
            if found["many"] == 1 or width == 1:
                nearer = start if w["goal"] - left <= right - w["goal"] else start + width
                done.append(w | {"cut": nearer})
            else:
                going.append(w | {"lo": start, "hi": min(start + width - 1, w["hi"]), "before": left})
        wanted = going
    return done


def tree(rows: DataFrame, dims: int, shards: int) -> list[list[dict]]:
    """The splits, level by level. A node is called by the first of the shards below it."""
    levels: list[list[dict]] = []
    below = {0: shards}
    while any(many > 1 for many in below.values()):
        now = assign(rows, levels)
        ends = [f(F.get("_keys", F.lit(i))).alias(f"{n}{i}") for i in range(dims) for n, f in (("lo", F.min), ("hi", F.max))]
        stats = {r["_node"]: r for r in now.groupBy("_node").agg(F.sum("_size").alias("bytes"), *ends).collect()}
        wanted, level = [], []
        for node, many in below.items():
            step = many // 2
            if many == 1:
                continue
            if node not in stats:
                level.append({"node": node, "dim": 0, "cut": 0, "step": step})
                continue
            s = stats[node]
            widest = max(range(dims), key=lambda i: (s[f"hi{i}"] // TIES - s[f"lo{i}"] // TIES, -i))
            wanted.append({
                "node": node, "dim": widest, "lo": s[f"lo{widest}"], "hi": s[f"hi{widest}"],
                "goal": s["bytes"] * step / many, "step": step,
            })
        level += _medians(now, wanted)
        levels.append([{k: w[k] for k in ("node", "dim", "cut", "step")} for w in level])
        below = {n: m for node, many in below.items() for n, m in ((node, many // 2 or 1), (node + many // 2, many - many // 2)) if m}
    return levels


def plan(
    docs: DataFrame, dims: list[str], shards: int | None, target_bytes: int | None, id_col: str, text_col: str
) -> tuple[DataFrame, Grid, list[list[dict]]]:
    """The numbers per row, stored; the grid; the tree."""
    own = numbers(docs, dims, id_col, text_col)
    rows = stored(docs.select(F.col(id_col).alias("doc_id"), *[v.alias(k) for k, v in own.items()]), "sizes")
    ranks = {c: value_ranks(rows, c) for c, kind in rows.dtypes if c.startswith("_v") and kind in ("string", "binary")}
    if ranks:
        rows = stored(ranked(rows, ranks), "ranked")
    of = [f(f"_v{i}").alias(f"{n}{i}") for i in range(len(dims)) for n, f in (("lo", F.min), ("hi", F.max))]
    ends = rows.agg(*of, F.sum("_size").alias("total")).first().asDict()
    total = ends.pop("total") or 0
    rows = on_grid(rows, ends)
    return rows, Grid(ends, ranks), tree(rows, len(dims), shards or max(1, math.ceil(total / target_bytes)))


def shard(
    docs: DataFrame, dims: list[str], shards: int | None = None, target_bytes: int | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of each row; give ``shards`` or ``target_bytes``.

    ``slot`` is gapless from 0 within a shard.
    """
    rows, _, levels = plan(docs, dims, shards, target_bytes, id_col, text_col)
    placed = assign(rows, levels).select(
        "doc_id", F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), F.col("_node").alias("shard"), "_tie"
    )
    return numbered(placed, "shard", ["doc_id", "_tie"], F.col("_tie"), "slot").drop("_tie")


def write_shards(
    docs: DataFrame, path: str, dims: list[str], shards: int | None = None, target_bytes: int | None = None,
    id_col: str = "doc_id", text_col: str = "text", files: int = 8,
) -> None:
    """Write ``docs`` as Parquet, one folder ``shard=N`` of up to ``files`` files per shard.

    A row's shard follows from its own values (of equal rows, from its number), so the texts are sent once, to the tasks
    that write them; once more for a string dimension whose values are too many to broadcast. An input
    column called ``shard`` is left out.
    """
    own = numbers(docs, dims, id_col, text_col)
    _, grid, levels = plan(docs, dims, shards, target_bytes, id_col, text_col)
    whole = F.struct(*[F.col(c) for c in docs.columns if c.lower() != "shard"]).alias("_doc")
    rows = ranked(docs.select(whole, *[v.alias(k) for k, v in own.items()]), grid.ranks)
    placed = assign(on_grid(rows, grid.ends), levels)
    out = placed.select("_doc.*", F.col("_node").alias("shard"), F.pmod("_tie", F.lit(files)).alias("_file"))
    out.repartition("shard", "_file").drop("_file").write.partitionBy("shard").parquet(path)
