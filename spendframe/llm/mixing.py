"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source should be copied ``target / source_size`` times: the whole part
is given to each, the fractional part is a probability.  Pivotal rounding turns the
probabilities into 0 or 1: two documents with fractions p and q meet, words move from one to
the other (size * fraction, summed over the two, stays the same) until one of them reaches
0 or 1, and the direction is drawn so that the expected value of both stays what it was.  The other carries on.  So the words taken from a source
differ from its target by less than the size of the one document that is left at the end.

A document that is a large part of its source would meet only much smaller ones and come
out fractional at the end.  So the documents above 1 / LARGE of their source (fewer than LARGE
of them, whatever the source's size) go first: each meets the pool of all smaller ones, is
taken or left with its probability, and the pool's common fraction takes up the difference
(where the pool cannot, the document goes the way that it can).

On Spark the rest is a reduction tree.  Level one deals the documents of each source into blocks
of about BLOCK rows by a hash; a fold over the sorted block leaves one fractional document per
block.  The next level does the same with those, until one block per source is left, and
that one document is drawn by its fraction.  Blocks are of bounded size whatever the size
of a source, the number of levels is logarithmic, and every draw is a hash of the two ids,
so reruns agree.  Only DataFrame functions are used; the per-source table (one row per
source) is the only thing that one task sees whole.

Defined results: a null or wordless text has size 0 and is never taken; null is a source of
its own, last in order; a null id is an ordinary id; repeated rows are separate documents and
rounded separately; an empty table gives an empty mix; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendframe.llm.common import materialize, split_words

BLOCK = 128
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
LARGE = 256

UNIT = "struct<size:bigint,id:bigint,p:double,base:int>"
DONE = "struct<size:bigint,id:bigint,copies:int>"


def word_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source") -> DataFrame:
    """(doc_id, source, size) of every row; size is the number of words."""
    df = split_words(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                                 F.col(text_col).alias("_t")), "_t", "_w")
    return df.select("doc_id", "source", F.size("_w").cast("bigint").alias("size"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, target): shares of the summed size by weight, none above ``most``
    times its source's size, the excess reshared by weight.

    With sources in ascending order of cap / weight the capped ones come first, so a running
    sum gives the level that the others share; one row per source is ordered here."""
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (place % len(weights) + 1).cast("int"))
    df = per_source.withColumn("w", w).withColumn("cap", (F.col("source_size") * most).cast("double"))
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("total", F.sum("source_size").over(whole).cast("double"))
    df = df.withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    df = df.withColumn("open_w", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    df = df.withColumn("level", (F.col("total") - F.col("capped")) / F.col("open_w"))
    # the first source that its level does not lift above the cap fixes the level of all after it
    fits = F.col("level") * F.col("w") <= F.col("cap")
    df = df.withColumn("shared", F.first(F.when(fits, F.col("level")), ignorenulls=True).over(
        by_cap.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    target = F.when(F.col("shared").isNull(), F.col("cap")).otherwise(
        F.least(F.col("cap"), F.col("shared") * F.col("w")))
    return df.select("source", "source_size", target.alias("target"))


def _draw(a: str, b: str, seed: int) -> str:
    """A uniform number in [0, 1) from two ids."""
    return f"(shiftrightunsigned(xxhash64({a}, {b}, {seed}L), 11) / 9007199254740992D)"


def _fold(seed: int) -> Column:
    """Fold of one block: acc.r meets x; words move until one of them is at 0 or 1."""
    r, ratio = "acc.r", "(x.size / acc.r.size)"
    up = f"least(1D - {r}.p, x.p * {ratio})"          # r gains this much
    down = f"least({r}.p, (1D - x.p) * {ratio})"      # or loses this much
    unit = lambda of, p: f"named_struct('size', {of}.size, 'id', {of}.id, 'p', {p}, 'base', {of}.base)"
    done = lambda of, one: f"named_struct('size', {of}.size, 'id', {of}.id, 'copies', {of}.base + {one})"
    acc = lambda d, u: f"named_struct('out', concat(acc.out, array({d})), 'r', {u})"
    gains = f"{_draw(r + '.id', 'x.id', seed)} * ({up} + {down}) < {down}"
    step = f"""CASE WHEN acc.r IS NULL THEN named_struct('out', acc.out, 'r', x)
        WHEN {gains} THEN
          CASE WHEN 1D - {r}.p <= x.p * {ratio} THEN {acc(done(r, 1), unit('x', f'x.p - (1D - {r}.p) / {ratio}'))}
               ELSE {acc(done('x', 0), unit(r, f'{r}.p + x.p * {ratio}'))} END
        ELSE
          CASE WHEN {r}.p <= (1D - x.p) * {ratio} THEN {acc(done(r, 0), unit('x', f'x.p + {r}.p / {ratio}'))}
               ELSE {acc(done('x', 1), unit(r, f'{r}.p - (1D - x.p) * {ratio}'))} END
        END"""
    start = f"named_struct('out', CAST(array() AS array<{DONE}>), 'r', CAST(NULL AS {UNIT}))"
    return F.expr(f"aggregate(block, {start}, (acc, x) -> CAST({step} AS struct<out:array<{DONE}>,r:{UNIT}>))")


def _large_fold(seed: int) -> Column:
    """Fold of a source's large documents, largest first: each meets the pool of the rest,
    which holds ``acc.words`` words to take out of ``acc.size``."""
    start = f"named_struct('out', CAST(array() AS array<{DONE}>), 'words', words, 'size', whole)"
    takes = (f"CASE WHEN acc.words < x.size AND acc.words <= acc.size - x.size THEN false "
             f"WHEN acc.words > acc.size - x.size AND acc.words >= x.size THEN true "
             f"ELSE {_draw('x.id', 'x.size', seed)} * acc.size < acc.words END")
    step = (f"named_struct('out', concat(acc.out, array(named_struct('size', x.size, 'id', x.id, "
            f"'copies', base + CAST({takes} AS INT)))), "
            f"'words', greatest(0D, least(acc.size - x.size, acc.words - CAST({takes} AS INT) * x.size)), "
            f"'size', acc.size - x.size)")
    kind = f"struct<out:array<{DONE}>,words:double,size:double>"
    return F.expr(f"aggregate(block, CAST({start} AS {kind}), (acc, x) -> CAST({step} AS {kind}))")


def pivotal_copies(sizes: DataFrame, targets: DataFrame, seed: int = 7, block: int = BLOCK) -> DataFrame:
    """(doc_id, source, size, copies): one row per row of ``sizes``."""
    n = sizes.count()
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    shares = targets.select(F.col("source").alias("_source"), F.col("source_size").alias("_size"),
                            F.floor(ratio).cast("int").alias("base"),
                            (ratio - F.floor(ratio)).alias("p"))
    own = F.col("source").eqNullSafe(F.col("_source"))
    tagged = sizes.where("size > 0").join(shares.select("_source", "_size"), own).select(
        "doc_id", "source", "size", (F.col("size") * LARGE > F.col("_size")).alias("large"))
    large = tagged.where("large").groupBy("source").agg(F.sort_array(F.collect_list(
        F.struct("size", F.col("doc_id").alias("id"))), asc=False).alias("block"))
    large = shares.join(large, own, "left").select(
        F.col("_source"), "base", F.coalesce("block", F.expr("CAST(array() AS array<struct<size:bigint,id:bigint>>)")).alias("block"),
        (F.col("p") * F.col("_size")).alias("words"), F.col("_size").cast("double").alias("whole"))
    first = materialize(large.withColumn("f", _large_fold(seed - 1)).select(
        "_source", "base", "f.out", F.when(F.col("f.size") > 0, F.col("f.words") / F.col("f.size")).otherwise(
            0.0).alias("p")).coalesce(1), "mix-large")
    shares = first.select("_source", F.col("base").alias("_base"), F.col("p").alias("_p"))
    rest = tagged.where("NOT large").select("source", F.struct(
        "size", F.col("doc_id").alias("id"), F.lit(None).cast("double").alias("p"),
        F.lit(None).cast("int").alias("base")).alias("u"))
    parts = [sizes.where("size = 0").select("doc_id", "source", "size", F.lit(0).alias("copies")),
             first.select(F.col("_source").alias("source"), F.explode("out").alias("d")).select(
                 F.col("d.id").alias("doc_id"), "source", F.col("d.size").alias("size"), "d.copies")]
    blocks, level = n, 0
    while True:
        blocks = -(-blocks // block)
        of = F.pmod(F.xxhash64("u.id", "u.size", F.lit(seed + level)), F.lit(max(blocks, 1)))
        groups = rest.groupBy("source", of.alias("b")).agg(
            F.sort_array(F.collect_list("u"), asc=False).alias("block"))
        if level == 0:
            groups = groups.join(shares, F.col("source").eqNullSafe(F.col("_source"))).select(
                "source", F.transform("block", lambda x: F.struct(
                    x["size"].alias("size"), x["id"].alias("id"), F.col("_p").alias("p"),
                    F.col("_base").alias("base"))).alias("block"))
        folded = materialize(groups.select("source", _fold(seed + level).alias("f")).select(
            "source", "f.out", "f.r"), "mix-level")
        parts.append(folded.select("source", F.explode("out").alias("d")).select(
            F.col("d.id").alias("doc_id"), "source", F.col("d.size").alias("size"), "d.copies"))
        rest = folded.select("source", F.col("r").alias("u"))
        level += 1
        if blocks <= 1:
            break
    drawn = F.expr(_draw("u.id", "u.size", seed + level)) < F.col("u.p")
    parts.append(rest.select(F.col("u.id").alias("doc_id"), "source", F.col("u.size").alias("size"),
                             (F.col("u.base") + drawn.cast("int")).alias("copies")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def mix(docs: DataFrame, seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) of every row of ``docs``."""
    sizes = materialize(word_sizes(docs, id_col, text_col, source_col), "mix-sizes")
    targets = materialize(source_targets(sizes).coalesce(1), "mix-targets")
    copies = pivotal_copies(sizes, targets, seed)
    t = targets.select(F.col("source").alias("_source"), "source_size", "target")
    return copies.join(t, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, seed: int = 7) -> DataFrame:
    """``docs`` as the mix takes them: each row as many times as its copies, none for 0.

    Rows with equal id, source and size share out their copies in the order of their texts."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "source", "text")
    rows = split_words(rows, "text", "words").select("row", "text", F.struct(
        F.col("doc_id").alias("id"), "source", F.size("words").cast("bigint").alias("size")).alias("key"))
    taken = mix(docs, seed).groupBy(F.struct(F.col("doc_id").alias("id"), "source", "size").alias("key")).agg(
        F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("text")))
    rows = rows.withColumn("place", place).join(taken, "key")
    share = (F.floor(F.col("copies") / F.col("rows")) + (F.col("place") <= F.col("copies") % F.col("rows")).cast("int")).cast("int")
    return rows.withColumn("copy", F.explode(F.array_repeat(F.lit(1), share))).select(
        *[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
