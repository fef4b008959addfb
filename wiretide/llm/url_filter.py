"""URL filter: host and path rules, then a weighted vocabulary found by one automaton.

Terms count where neither neighbour goes on with the word: no letter beside a letter, no
digit beside a digit, so `casino24` holds `casino` and `casinos` does not. One strict term
rejects, and so do SOFT_HITS different soft ones. The vocabulary is a parameter, which
`vocabulary` reads from a table of weighted terms.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wiretide.llm.common import column

#: Terms a vocabulary may have: the automaton is shipped to every task.
MOST_TERMS = 100_000
STRICT = ("casino", "porn", "xxx", "escort", "viagra", "hentai", "phishing", "malware", "warez")
SOFT = ("spam", "farm", "ads", "track", "free", "bets", "bet", "win", "poker", "cheap", "pills", "loan", "click", "adult", "jackpot", "bonus")
SOFT_HITS = 2

# Host, path and verdict, fixed by the query's contract.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def with_host_and_path(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds host (A-Z lower-cased) and path; both empty for a null url or one without ://."""
    rest = F.when(F.instr(url_col, "://") > 0, F.expr(f"substring(`{url_col}`, instr(`{url_col}`, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return pages.withColumn("host", F.coalesce(lowered, F.lit(""))).withColumn("path", F.coalesce(path, F.lit("")))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """The longest rule that fits, as a struct of rule and verdict, else null."""
    chosen = None
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        value = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        chosen = F.when(fits, value) if chosen is None else chosen.when(fits, value)
    return chosen if chosen is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


@lru_cache(maxsize=4)
def _automaton(strict: tuple[str, ...], soft: tuple[str, ...]):
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for weight, terms in ((0, soft), (1, strict)):
        for term in terms:
            automaton.add_word(term, (weight, term))
    if len(automaton):
        automaton.make_automaton()
    return automaton


def count_terms(url: str | None, strict: tuple[str, ...], soft: tuple[str, ...]) -> tuple[int, int]:
    """Strict hits and different soft terms of one url, A-Z lower-cased."""
    automaton = _automaton(strict, soft)
    if not url or not len(automaton):
        return 0, 0
    text = url.translate(_LOWER)
    hits, found = 0, set()
    for end, (weight, term) in automaton.iter(text):
        begin = end - len(term) + 1
        if _goes_on(text[begin - 1 : begin], term[0]) or _goes_on(term[-1], text[end + 1 : end + 2]):
            continue
        if weight:
            hits += 1
        else:
            found.add(term)
    return hits, len(found)


_CASES = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_LOWER = str.maketrans(*_CASES)
_LETTERS, _DIGITS = frozenset("abcdefghijklmnopqrstuvwxyz"), frozenset("0123456789")


def _goes_on(left: str, right: str) -> bool:
    """Whether two neighbours belong to one word; an end of the text does not."""
    return (left in _LETTERS and right in _LETTERS) or (left in _DIGITS and right in _DIGITS)


def vocabulary(table: DataFrame, term_col: str = "term", weight_col: str = "weight", strict_weight: float = 1.0) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """Strict terms (of that weight or more) and soft ones (of a smaller weight above 0), for `judge`.

    A-Z are lower-cased, a repeated term has its greatest weight; null and empty terms and
    those without a weight are left out. More than MOST_TERMS terms are an error.
    """
    terms = table.select(F.translate(column(term_col), *_CASES).alias("term"), column(weight_col).cast("double").alias("weight"))
    terms = terms.filter((F.length("term") > 0) & (F.col("weight") > 0) & ~F.isnan("weight"))
    found = terms.groupBy("term").agg(F.max("weight").alias("weight")).orderBy("term").limit(MOST_TERMS + 1).collect()
    if len(found) > MOST_TERMS:
        raise ValueError(f"a vocabulary has at most {MOST_TERMS} terms")
    strict = tuple(r["term"] for r in found if r["weight"] >= strict_weight)
    return strict, tuple(r["term"] for r in found if r["weight"] < strict_weight)


def term_counts(url: Column, strict: Sequence[str] = STRICT, soft: Sequence[str] = SOFT) -> Column:
    """Struct of strict_hits and soft_terms, found by the automaton, Arrow batch by batch."""
    strict, soft = tuple(strict), tuple(soft)

    @F.pandas_udf("strict_hits long, soft_terms long")
    def count(urls: pd.Series) -> pd.DataFrame:
        rows = [count_terms(u, strict, soft) for u in urls]
        return pd.DataFrame(rows, columns=["strict_hits", "soft_terms"])

    return count(url)


def judge(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    strict: Sequence[str] = STRICT,
    soft: Sequence[str] = SOFT,
    soft_hits: int = SOFT_HITS,
) -> DataFrame:
    """Per row: id, host, path, rule, verdict, strict_hits, soft_terms.

    A rule decides where one fits; else the vocabulary, over the whole url. Null and
    empty urls have no host, fit no rule and are allowed. Repeated rows stay repeated.
    """
    table = pages.select(F.col(id_col), F.col(url_col).alias("url"))
    table = with_host_and_path(table).withColumn("terms", term_counts(F.col("url"), strict, soft))
    table = table.withColumn("by_rule", rule_of(F.col("host"), F.col("path"), rules))
    bad = (F.col("terms.strict_hits") > 0) | (F.col("terms.soft_terms") >= soft_hits)
    verdict = F.coalesce(F.col("by_rule.verdict"), F.when(bad, "block").otherwise("allow"))
    return table.select(id_col, "host", "path", F.col("by_rule.rule").alias("rule"), verdict.alias("verdict"), "terms.strict_hits", "terms.soft_terms")
