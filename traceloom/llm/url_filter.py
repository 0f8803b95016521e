"""URL filter: a weighted vocabulary, found by an Aho-Corasick automaton, after host and path rules.

A term counts where neither neighbour is a letter or digit. A term of weight 1
or more is strict, and one of them rejects a url; of the others, soft terms, as
many distinct ones reject it as weigh 1 together.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
STRICT = ("casino", "escort", "hardcore", "hentai", "phishing", "porn", "spam", "viagra", "warez", "xxx")
SOFT = ("adult", "bet", "bets", "bonus", "cheap", "crack", "deal", "download", "farm", "free", "hot", "jackpot", "loan", "mp3", "pills", "poker", "promo", "rx", "sex", "slots", "torrent", "win")
VOCABULARY = {t: 1.0 for t in STRICT} | {t: 0.5 for t in SOFT}
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a url column; both empty without ``://``."""
    u = F.coalesce(F.col(url), F.lit(""))
    host = F.translate(F.regexp_extract(u, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(u, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def read_vocabulary(terms: DataFrame, max_terms: int = 1_000_000) -> dict[str, float]:
    """The vocabulary of a table (term, weight): A-Z lower-cased, the largest weight of a repeated term.

    Rows without a term or a positive weight are left out. A table of more than
    ``max_terms`` rows is an error, since every task holds the automaton.
    """
    rows = terms.where("term <> '' AND weight > 0").select(F.translate("term", UPPER, LOWER), F.col("weight").cast("double")).limit(max_terms + 1).collect()
    if len(rows) > max_terms:
        raise ValueError(f"a vocabulary of more than {max_terms} terms")
    out: dict[str, float] = {}
    for term, weight in rows:
        out[term] = max(weight, out.get(term, 0.0))
    return out


def term_hits(vocabulary: dict[str, float]):
    """A pandas UDF: of each url, the strict terms counted, the distinct soft ones, and the weight of these."""

    @F.pandas_udf("strict long, soft long, weight double")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        found = ahocorasick.Automaton()
        for t, weight in vocabulary.items():
            found.add_word(t, t)
        if vocabulary:
            found.make_automaton()
        fold = str.maketrans(UPPER, LOWER)
        word = frozenset(LOWER + "0123456789")
        for urls in batches:
            rows = []
            for u in urls:
                u = (u or "").translate(fold)
                hard, mild = 0, set()
                for end, t in found.iter(u) if vocabulary else ():
                    start = end + 1 - len(t)
                    if (start == 0 or u[start - 1] not in word) and (end + 1 == len(u) or u[end + 1] not in word):
                        if vocabulary[t] >= 1:
                            hard += 1
                        else:
                            mild.add(t)
                rows.append((hard, len(mild), sum(map(vocabulary.get, sorted(mild)), 0.0)))
            yield pd.DataFrame(rows, columns=["strict", "soft", "weight"]).astype({"strict": "int64", "soft": "int64", "weight": "float64"})

    return count


def judge_urls(pages: DataFrame, rules=RULES, vocabulary: dict[str, float] | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, strict_hits, soft_hits) of every page.

    The longest rule that fits decides; without one the vocabulary does (see
    ``read_vocabulary`` for one from a table). A null url has an empty host and
    path, no term, and is allowed. Repeated rows are each judged, urls of any
    length are read whole, and no pages give no rows. Only page_id and url are
    read, so other columns may have any name.
    """
    host, path = host_and_path("url")
    read = pages.select("page_id", "url", host.alias("host"), path.alias("path")).withColumn("hits", term_hits(VOCABULARY if vocabulary is None else vocabulary)(F.col("url")))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is tried first
        fits = ((F.col("host") == name) | F.col("host").endswith("." + name)) & F.col("path").startswith(start)
        rule, verdict = F.when(fits, F.lit(name + start)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    own = F.when((F.col("hits.strict") > 0) | (F.col("hits.weight") >= 1), F.lit("block")).otherwise(F.lit("allow"))
    return read.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), F.col("hits.strict").alias("strict_hits"), F.col("hits.soft").alias("soft_hits"))
