"""Mixing sources to target weights by systematic sampling, in DataFrame functions only.

Within a source every document expects target / size copies of itself. Documents are
laid end to end by these expectations, shifted by one random offset per source, and a
document is emitted once per whole number that its stretch crosses. They are laid out by
size (classes 1/32 of an octave wide, random order within), so the words taken stay
within about one large document of the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wiretide.llm.common import WORD, column, fresh_name

MOST_COPIES = 3


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def unit_draw(*parts: Column | str) -> Column:
    """A number in [0, 1) that depends on the parts alone: the first 8 hex digits of an md5."""
    text = F.concat_ws("|", *[F.lit(p) if isinstance(p, str) else p for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def _stratum(size: Column) -> Column:
    """Size classes: single sizes below 64, then 32 to each doubling."""
    octave = F.length(F.bin(size)) - 1
    shifted = F.floor(size / F.pow(F.lit(2.0), octave - 5)).cast("long")
    return F.when(size < 64, size).otherwise(octave.cast("long") * 32 + shifted)


def source_targets(sizes: DataFrame) -> DataFrame:
    """One row per source: source, source_size, target, rate.

    Weights are 1, 2, 3, repeating over the sources by code point, null last. A source
    stops at MOST_COPIES times its size; what it leaves goes to the others by weight,
    until none is above. That end state is min(cap, level * weight) for one level, found
    in order of cap / weight. Works on one row per source, in one task.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("long"))
    per = per.withColumn("cap", F.col("source_size") * MOST_COPIES)
    filling = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy(F.lit(0))
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    open_weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    per = per.withColumn("left", left).withColumn("open_weight", open_weight)
    # The first source that its share does not fill sets the level for all after it.
    holds = F.col("left") * F.col("weight") <= F.col("cap") * F.col("open_weight")
    per = per.withColumn("level", F.min(F.when(holds, F.struct(F.col("cap") / F.col("weight"), "source", "left", "open_weight"))).over(whole))
    share = F.col("level.left") * F.col("weight") / F.col("level.open_weight")
    per = per.withColumn("target", F.least(F.col("cap").cast("double"), share.cast("double")))
    rate = F.least(F.lit(float(MOST_COPIES)), F.col("target") / F.col("source_size"))
    return per.select("source", "source_size", "target", F.when(F.col("source_size") > 0, rate).otherwise(0.0).alias("rate"))


def with_copies(rows: DataFrame, source_col: str, id_col: str, size: Column, seed: str, into: str) -> DataFrame:
    """Adds struct `into`: size, source_size, target, copies.

    Ranks within a source come from three levels, so a source of any share is spread
    over many tasks: rows within blocks (size class and one of sqrt(rows) slots), blocks
    within a size class, size classes within a source. Repeated rows are taken for
    different documents; a null id counts as empty text.
    """
    slots = F.greatest(F.lit(1), F.ceil(F.sqrt(F.lit(rows.count())))).cast("long")
    draw_id = F.coalesce(column(id_col).cast("string"), F.lit(""))
    inner = rows.withColumn(
        into,
        F.struct(
            F.concat(F.lit("="), column(source_col)).alias("source"),
            size.alias("size"),
            _stratum(size).alias("stratum"),
            F.floor(unit_draw(seed, draw_id) * slots).cast("long").alias("slot"),
            F.md5(F.concat_ws("|", F.lit(seed), draw_id)).alias("order"),
        ),
    ).withColumn(into, F.col(into).withField("source", F.coalesce(F.col(f"{into}.source"), F.lit(""))))
    block = ["source", "stratum", "slot"]
    blocks = inner.select(f"{into}.*").groupBy(block).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    blocks = blocks.select("*")
    by_slot = Window.partitionBy("source", "stratum").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    by_stratum = Window.partitionBy("source").orderBy("stratum").rowsBetween(Window.unboundedPreceding, -1)
    strata = blocks.groupBy("source", "stratum").agg(F.sum("n").alias("n"))
    strata = strata.select("source", "stratum", F.coalesce(F.sum("n").over(by_stratum), F.lit(0)).alias("strata_before"))
    blocks = blocks.select(*block, F.coalesce(F.sum("n").over(by_slot), F.lit(0)).alias("slots_before"))
    targets = source_targets(
        inner.select(f"{into}.*").groupBy("source").agg(F.sum("size").alias("size"))
        .select(F.when(F.col("source") != "", F.substring("source", 2, 1 << 30)).alias("source"), "size")
    ).withColumn("source", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
    base = (
        blocks.join(strata, ["source", "stratum"])
        .join(targets, "source")
        .select(F.struct(*block).alias("block"), F.struct((F.col("slots_before") + F.col("strata_before")).alias("before"), "source_size", "target", "rate").alias("base"))
    )
    key = F.struct(*[F.col(f"{into}.{c}").alias(c) for c in block])
    in_block = Window.partitionBy(*[F.col(f"{into}.{c}") for c in block]).orderBy(F.col(f"{into}.order"), column(id_col))
    ranked = inner.withColumn(into, F.col(into).withField("rank", F.row_number().over(in_block).cast("long")))
    left = ranked.select(F.struct(*map(column, ranked.columns)).alias("row"), *[F.col(f"{into}.{c}").alias(f"k_{c}") for c in block])
    right = base.select(*[F.col(f"block.{c}").alias(f"k_{c}") for c in block], "base")
    joined = left.join(right, [f"k_{c}" for c in block])
    mix = F.col(f"row.{into}")
    offset = unit_draw(seed, "offset", mix["source"])
    rank = mix["rank"] + F.col("base.before")
    crossed = F.floor(rank * F.col("base.rate") + offset) - F.floor((rank - 1) * F.col("base.rate") + offset)
    out = F.struct(mix["size"].alias("size"), F.col("base.source_size").alias("source_size"), F.col("base.target").alias("target"), crossed.cast("long").alias("copies"))
    return joined.select(*[F.col("row")[c].alias(c) for c in rows.columns], out.alias(into))


def mix(docs: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id", seed: str = "mix") -> DataFrame:
    """The mixed rows: every document as often as it is taken, with its own columns.

    Null texts have no words; null sources are one source. An empty table gives none.
    """
    into = fresh_name(docs.columns, "mix")
    taken = with_copies(docs, source_col, id_col, word_count(column(text_col)), seed, into)
    again = fresh_name([*docs.columns, into], "copy")
    return taken.filter(F.col(into)["copies"] > 0).withColumn(again, F.explode(F.sequence(F.lit(1), F.col(into)["copies"]))).select(*map(column, docs.columns))
