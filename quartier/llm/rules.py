"""Quality rules as a bitmask ledger (DataFrame expressions only).

Every rule is evaluated once per document. The ledger keeps the measurements
and one long of failure bits; policies are masks over those bits, so a new
policy version, or an ablation of a rule, reads the ledger and never the text.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, texts

# The characters counted as symbols.
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A named failure condition over the ledger's measurements."""
    name: str
    bit: int
    fails: Column

    @property
    def mask(self) -> int:
        return 1 << self.bit


def default_rules() -> list[Rule]:
    c = F.col
    return [
        Rule("few_words", 0, c("n_words") < 50),
        Rule("repeated_words", 1, 100 * c("n_repeat_words") > 50 * c("n_words")),
        Rule("symbols", 2, 10 * c("n_symbols") > 3 * c("n_words")),
        Rule("duplicate_lines", 3, 10 * c("n_dup_lines") > 3 * c("n_lines")),
        Rule("capitals", 4, 2 * c("n_capital_words") > c("n_words")),
        Rule("long_words", 5, c("word_chars") > 20 * c("n_words")),
        Rule("short_words", 6, c("word_chars") < 2 * c("n_words")),
    ]


#: Versioned policies: the rules whose failure rejects a document.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "duplicate_lines", "capitals",
           "long_words", "short_words"),
}


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of each text, one row per input row.

    Words are runs of bytes other than space and 0x09-0x0D. A null or empty
    text has none and measures 0 everywhere; a null doc_id stays null; repeated
    rows give repeated results; an empty table gives an empty result. Columns
    other than doc_id and text are ignored.
    """
    text = F.col("text")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    d = texts(docs).select(
        "doc_id", text, lines.alias("lines"),
        F.array_remove(F.split(text, ASCII_SPACE + "+"), "").alias("w"))
    n = F.size("w")
    d = d.select(
        "doc_id", "w", n.cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit("[" + SYMBOLS + "]")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        # possessive up to the first pair of capitals: a long word is read once
        F.regexp_count(text, F.lit(
            r"(?<![^\x20\x09-\x0D])(?:[^\x20\x09-\x0Da-zA-Z]|[A-Z](?![A-Z]))*+[A-Z]{2}"
            r"[^\x20\x09-\x0Da-z]*+(?![^\x20\x09-\x0D])"))
        .cast("long").alias("n_capital_words"),
        # one 64-bit hash per window of three words
        F.when(n >= 3, F.transform(
            F.slice("w", 1, n - 2),
            lambda a, i: F.xxhash64(a, F.col("w")[i + 1], F.col("w")[i + 2]))).alias("h"))
    # Only texts in which a hash occurs twice can hold a repeated window.
    d = d.withColumn("s", F.when(
        F.size(F.array_distinct("h")) < F.size("h"),
        F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("x"), i.alias("p"))))))
    d = d.withColumn("t", F.filter("s", lambda e, i: _twin(F.col("s"), e, i, ("x",))))
    # Equal hashes are settled by the words themselves.
    w = F.col("w")
    d = d.withColumn("t", F.sort_array(F.transform("t", lambda e: F.struct(
        e["x"].alias("x"),
        F.concat_ws(" ", w[e["p"]], w[e["p"] + 1], w[e["p"] + 2]).alias("g"),
        e["p"].alias("p")))))
    d = d.withColumn("p", F.array_sort(F.transform(
        F.filter("t", lambda e, i: _twin(F.col("t"), e, i, ("x", "g"))), lambda e: e["p"])))
    # Windows starting at p cover p..p+2; overlapping windows count a word once.
    covered = F.aggregate(
        "p", F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"),
                                p.alias("last")),
        lambda acc: acc["n"])
    # The generator keeps a later filter on a measurement from being inlined
    # through the steps above, which would repeat them without end.
    return d.select(F.inline(F.array(F.struct(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        "n_lines", "n_capital_words"))))


def _twin(arr: Column, e: Column, i: Column, fields: tuple[str, ...]) -> Column:
    """Entry i of a sorted array equals a neighbour in ``fields``."""
    def same(other: Column) -> Column:
        out = F.lit(True)
        for f in fields:
            out = out & (other[f] == e[f])
        return F.coalesce(out, F.lit(False))
    before = F.when(i > 0, same(F.get(arr, i - 1))).otherwise(F.lit(False))
    return before | same(F.get(arr, i + 1))


def ledger(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """The measurements plus ``fail_bits``: bit b is set if the rule of bit b fails."""
    bits = F.lit(0).cast("long")
    for r in rules or default_rules():
        bits = bits.bitwiseOR(F.when(r.fails, F.lit(r.mask).cast("long"))
                              .otherwise(F.lit(0).cast("long")))
    return measure(docs).withColumn("fail_bits", bits)


def policy_mask(policy: str, rules: list[Rule] | None = None,
                policies: Mapping[str, tuple[str, ...]] = POLICIES) -> int:
    by_name = {r.name: r.mask for r in rules or default_rules()}
    mask = 0
    for name in policies[policy]:
        mask |= by_name[name]
    return mask


def passes(policy: str, rules: list[Rule] | None = None) -> Column:
    """Verdict of a policy over a ledger: no bit of its mask is set."""
    return F.col("fail_bits").bitwiseAND(F.lit(policy_mask(policy, rules)).cast("long")) == 0


def ablation(led: DataFrame, policy: str, rules: list[Rule] | None = None) -> DataFrame:
    """Per rule of a policy: documents it fails, and those only it rejects
    (what dropping the rule would let in). Bit patterns are counted first, so
    at most one row per pattern is shuffled."""
    rules = rules or default_rules()
    mask = policy_mask(policy, rules)
    pattern = (led.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")).alias("bits"))
               .agg(F.count("*").alias("n")))
    listed = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.mask).cast("long").alias("m"))
                       for r in rules if r.mask & mask])
    r = pattern.select("bits", "n", F.explode(listed).alias("r"))
    hit = F.col("bits").bitwiseAND(F.col("r.m")) != 0
    return r.groupBy(F.col("r.rule").alias("rule")).agg(
        F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("n_failed"),
        F.coalesce(F.sum(F.when(F.col("bits") == F.col("r.m"), F.col("n"))), F.lit(0))
        .alias("n_only"))
