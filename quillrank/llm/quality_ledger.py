"""Quality rules as a ledger: one pass measures every rule, versioned policies are applied to its bits.

``ledger`` stores per text the measurements and ``failed``, a bit mask with bit ``i`` set if rule ``i``
fails. ``verdicts`` applies a policy, which is a mask of the rules that count, without looking at the
text again; ``ablation`` says for each rule how many texts it fails, how many it alone rejects, and
how many a policy without it keeps, all from the masks.

Defined results: a null or empty text has no words, fails the rules on sizes, and is rejected; very
long texts are measured whole, in n log n time; rows are independent, so repeated rows, ties and
further columns do not matter (a further column that has the name of a result column is an error of
the caller: ``ledger`` returns key and results only); an empty table gives an empty ledger.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space that parts words, and the characters counted as symbols.
WHITE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

#: Rules in the order of their bits: name and the SQL condition under which a text fails.
#: A rule keeps its bit for good; new rules go to the end.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "many_symbols": "10 * n_symbols > n_words",
    "repeated_lines": "n_dup_lines >= 3 and 10 * n_dup_lines > 3 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 15 * n_words",
    "shouting": "2 * n_shouts > n_words",
    "same_words": "n_words >= 50 and 10 * n_runs > n_words",
}
BASE = ("few_words", "repeated_words")
#: Policies by version: the names of the rules that count.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": BASE,
    "v1": (*BASE, "many_symbols", "repeated_lines"),
    "v2": tuple(RULES),
}
CURRENT = "v2"


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def mask(rules: tuple[str, ...]) -> int:
    return sum(bit(rule) for rule in rules)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, as a lambda's variable."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _covered(windows: Column) -> Column:
    """Words in windows that occur twice or more, from the sorted pairs of hash and place.

    Repeated windows stand side by side once sorted. Their places, sorted again, each add the three
    words of the window less those that the window before has already covered.
    """
    pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(all_pairs: Column) -> Column:
        return F.filter(
            all_pairs,
            lambda x, k: (F.get(all_pairs, k - 1)["h"] == x["h"]) | (F.get(all_pairs, k + 1)["h"] == x["h"]),
        )

    places = F.array_sort(F.transform(_bound(pairs, repeated), lambda x: x["i"]))
    counted = F.aggregate(
        places,
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda s, p: F.struct((s["n"] + F.least(p - s["last"], F.lit(3))).alias("n"), p.alias("last")),
        lambda s: s["n"],
    )
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(counted)


def measurements(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key`` and what the rules look at, in one row-wise pass."""
    split = df.select(
        F.col(key).alias("key"),
        F.coalesce(F.col(text), F.lit("")).alias("t"),
    ).select(
        "key",
        "t",
        F.when(F.btrim("t", F.lit(WHITE)) == "", F.array().cast("array<string>"))
        .otherwise(F.split(F.btrim("t", F.lit(WHITE)), "[\\x20\\x09-\\x0D]+"))
        .alias("words"),
        F.filter(F.split("t", "\n"), lambda line: F.btrim(line, F.lit(WHITE)) != "").alias("lines"),
    )
    windows = F.transform(
        F.sequence(F.lit(0), F.size("words") - 3),
        lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)),
    )
    runs = F.filter("words", lambda w, i: F.get("words", i + 1) == w)
    return split.select(
        F.col("key").alias(key),
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("t", f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("words") >= 3, _bound(windows, _covered)).otherwise(0).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.regexp_count("t", F.lit("\\p{Lu}{3,}")).cast("long").alias("n_shouts"),
        F.size(runs).cast("long").alias("n_runs"),
    )


def ledger(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, the measurements and ``failed`` (long): every rule evaluated once."""
    measured = measurements(df, key, text)
    failed = F.lit(0).cast("long")
    for rule, condition in RULES.items():
        failed = failed.bitwiseOR(F.when(F.expr(condition), F.lit(bit(rule))).otherwise(0).cast("long"))
    return measured.withColumn("failed", failed)


def verdicts(entries: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Ledger rows with ``base_failed`` and ``kept`` under a policy; base rules always count."""
    counted = mask(POLICIES[policy]) | mask(BASE)
    return entries.withColumn(
        "base_failed", F.col("failed").bitwiseAND(F.lit(mask(BASE))) != 0
    ).withColumn("kept", F.col("failed").bitwiseAND(F.lit(counted)) == 0)


def ablation(entries: DataFrame, policies: Mapping[str, tuple[str, ...]] = POLICIES) -> DataFrame:
    """One row for each policy and rule of it, from one aggregation of the masks.

    ``failing``: texts that fail the rule; ``alone``: that fail no other rule of the policy;
    ``kept_without``: kept by the policy without the rule; ``kept``: by the whole policy.
    """
    by_mask = entries.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))  # at most 2**rules rows

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    rows = []
    for name, rules in policies.items():
        whole = mask(rules)
        for rule in rules:
            failed, own = F.col("failed"), bit(rule)
            without = failed.bitwiseAND(F.lit(whole & ~own)) == 0
            fails = failed.bitwiseAND(F.lit(own)) != 0
            rows.append(
                F.struct(
                    F.lit(name).alias("policy"),
                    F.lit(rule).alias("rule"),
                    total(fails).alias("failing"),
                    total(fails & without).alias("alone"),
                    total(without).alias("kept_without"),
                    total(failed.bitwiseAND(F.lit(whole)) == 0).alias("kept"),
                )
            )
    return by_mask.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
