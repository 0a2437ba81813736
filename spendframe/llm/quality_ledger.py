"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger stores the measurements and one
integer whose bit k says that rule k failed; a policy is a versioned set of bits.  Applying
another policy, or asking what a rule removes on its own, reads the ledger only and never
the texts again.

Only DataFrame functions are used.  Words, lines and three-word windows are arrays inside
the row, so measuring needs no shuffle at all and no row depends on another row.

Defined results: a null text has no words; an empty text too (both fail `few_words`); a
null in another column does not matter; repeated rows each get their own row; an empty table
gives an empty ledger; further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendframe.llm.common import split_words

SYMBOLS = "[#*$%&|<>]"
LINE = r"[^\x20\x09-\x0D]"
#: Bits that hold a window's place in the first sort of `_repeated_positions`.
PLACE_BITS = 24

#: (name, condition on the measurements); the place in the list is the bit.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbol_ratio", "100 * n_symbols > 10 * n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 60 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
]
BIT = {name: 1 << k for k, (name, _) in enumerate(RULES)}
#: Versions of the policy: the rules whose failure removes a document.
POLICIES: dict[str, list[str]] = {
    "base": ["few_words", "repeated_windows"],
    "v1": [name for name, _ in RULES],
}


def mask_of(policy: str | list[str]) -> int:
    names = POLICIES[policy] if isinstance(policy, str) else policy
    return sum(BIT[n] for n in set(names))


def _window_hash(i: Column) -> Column:
    return F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2))


def _repeated_positions(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words that lie in a three-word window found twice or more.

    Windows are compared by a 64-bit hash.  First the places are sorted as plain longs, the
    upper bits of the hash above the place, and those whose upper bits have no equal
    neighbour drop out; the few left are sorted again by the whole hash.  Equal neighbours
    then give the places, each covering three words less its overlap with the next.  A text
    whose places do not fit the lower bits takes the second sort alone."""
    n = F.size("_w") - 2
    low = (1 << PLACE_BITS) - 1
    upper = F.lit(~low).cast("bigint")
    packed = F.transform(F.sequence(F.lit(0), n - 1), lambda i: _window_hash(i).bitwiseAND(upper).bitwiseOR(
        i.cast("bigint")))
    df = df.withColumn("_k", F.when((n >= 2) & (n <= low), F.sort_array(packed)))

    def near(x: Column, j: Column) -> Column:
        same = lambda y: F.coalesce(y.bitwiseAND(upper) == x.bitwiseAND(upper), F.lit(False))
        return same(F.get("_k", j + 1)) | ((j > 0) & same(F.get("_k", j - 1)))

    df = df.withColumn("_c", F.when(n > low, F.sequence(F.lit(0), n - 1)).otherwise(F.transform(
        F.filter("_k", near), lambda x: x.bitwiseAND(F.lit(low).cast("bigint")).cast("int"))))
    df = df.withColumn("_s", F.sort_array(F.transform(
        "_c", lambda i: F.struct(_window_hash(i).alias("h"), i.alias("i")))))

    def repeated(x: Column, j: Column) -> Column:
        return (F.coalesce(F.get("_s", j + 1)["h"] == x["h"], F.lit(False))
                | ((j > 0) & F.coalesce(F.get("_s", j - 1)["h"] == x["h"], F.lit(False))))

    df = df.withColumn("_p", F.sort_array(F.transform(F.filter("_s", repeated), lambda x: x["i"])))
    covered = F.aggregate(
        F.transform("_p", lambda p, j: F.least(F.lit(3), F.coalesce(F.get("_p", j + 1) - p, F.lit(3)))),
        F.lit(0), lambda a, x: a + x)
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint")).drop(
        "_k", "_c", "_s", "_p")


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, measurements, fail_bits) of every row of ``docs``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = split_words(docs.select(F.col(id_col), text.alias("_t")), "_t", "_w")
    df = df.withColumn("_l", F.filter(F.split("_t", "\n"), lambda x: x.rlike(LINE)))
    df = df.select(
        F.col(id_col), "_w",
        F.size("_w").cast("bigint").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("_t", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        F.size("_l").cast("bigint").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint").alias("n_dup_lines"))
    df = _repeated_positions(df).drop("_w")
    bits = F.lit(0).cast("bigint")
    for name, condition in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(BIT[name])).otherwise(F.lit(0)).cast("bigint"))
    return df.withColumn("fail_bits", bits)


def apply_policy(ledger_df: DataFrame, policy: str | list[str], out: str = "kept") -> DataFrame:
    """Adds ``out``: no rule of the policy failed."""
    return ledger_df.withColumn(out, F.col("fail_bits").bitwiseAND(F.lit(mask_of(policy))) == 0)


def ablations(ledger_df: DataFrame, policy: str | list[str]) -> DataFrame:
    """One row per rule of the policy: documents that fail it, documents that fail nothing
    else of the policy (they come back without the rule), and documents kept without it.

    The ledger is first reduced to one row per bit pattern, at most 2^rules of them."""
    mask = mask_of(policy)
    names = POLICIES[policy] if isinstance(policy, str) else policy
    patterns = ledger_df.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask)).alias("bits")).agg(
        F.count("*").alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(BIT[n]).cast("bigint").alias("bit"))
                                for n in names])).alias("r")
    fails = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    alone = F.col("bits") == F.col("r.bit")
    zero = F.lit(0).cast("bigint")
    return patterns.select("bits", "n", rules).groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(fails, F.col("n")).otherwise(zero)).alias("failed"),
        F.sum(F.when(alone, F.col("n")).otherwise(zero)).alias("failed_alone"),
        F.sum(F.when((F.col("bits") == 0) | alone, F.col("n")).otherwise(zero)).alias("kept_without"))
