"""URL filter by a weighted vocabulary, under rules for hosts and paths.

The vocabulary maps terms to weights.  All terms are compiled into one
Aho-Corasick automaton, every URL is read through it once, and a hit counts
where no letter or digit stands on either side of it.  A URL is rejected once
the weights of its distinct terms reach ``LIMIT``: one strict term weighs as
much as the limit, a soft term half, so that one strict or two different soft
terms reject and no repetition of a single soft term does.

Rules for a host and the beginning of a path come before the vocabulary; of
those that fit, the longest decides.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import lru_cache
from typing import NamedTuple
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STRICT = 2
SOFT = 1
LIMIT = 2
#: Characters of a vocabulary, or of rules, that go to every task with the code.
MOST_CHARACTERS = 1 << 22

# Terms that name adult, gambling or drug-selling sites whatever stands beside them.
STRICT_TERMS = (
    "camgirl", "camgirls", "cialis", "escorts", "hentai", "milf", "nsfw", "onlinecasino", "porn", "porno", "pornos", "sexcam", "sexcams", "viagra", "xxx")
# Terms that say little alone: two different ones are too many.
SOFT_TERMS = (
    "adult", "adults", "babes", "bet", "bets", "betting", "bonus", "buy", "cam", "cams", "casino", "casinos", "cheap", "cheapest", "crack", "cracked", "dating",
    "discount", "erotic", "escort", "farm", "fetish", "free", "gambling", "girls", "hookup", "hot", "jackpot", "keygen", "loan", "loans", "meds", "naked",
    "nude", "nudes", "payday", "pharmacy", "pill", "pills", "poker", "replica", "roulette", "sex", "sexy", "slot", "slots", "spam", "torrent", "viral",
    "warez", "webcam", "x", "xx")
VOCABULARY: dict[str, int] = dict.fromkeys(STRICT_TERMS, STRICT) | dict.fromkeys(SOFT_TERMS, SOFT)

#: What a term's neighbour must not be: ASCII letters, digits and all characters beyond ASCII.
WORD = re.compile(r"[a-z0-9\x80-\U0010ffff]")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
HITS = "strict int, soft int, weight int"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the registered query, fixed by its contract.
RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


class Vocabulary:
    """The automaton of a vocabulary."""

    def __init__(self, weights: Iterable[tuple[str, int]], limit: int):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for term, weight in weights:
            self.automaton.add_word(term, (term, weight))
        self.automaton.make_automaton()
        self.limit = limit

    def hits(self, url: str | None) -> tuple[int, int, int]:
        """Distinct strict terms, distinct soft terms and their weight."""
        if not url or not len(self.automaton):
            return 0, 0, 0
        if "%" in url:
            url = unquote(url)
        url = url.translate(LOWER)
        found = {}
        for end, (term, weight) in self.automaton.iter(url):
            start = end + 1 - len(term)
            if not (start and WORD.match(url[start - 1]) or WORD.match(url, end + 1)):
                found[term] = weight
        strict = sum(w >= self.limit for w in found.values())
        return strict, len(found) - strict, sum(found.values())


@lru_cache(maxsize=4)
def _compiled(weights: tuple[tuple[str, int], ...], limit: int) -> Vocabulary:
    return Vocabulary(weights, limit)


def vocabulary_hits(url: Column, vocabulary: Mapping[str, int] = VOCABULARY, limit: int = LIMIT) -> Column:
    """(strict, soft, weight): how many distinct strict and soft terms a URL
    holds, and what they weigh together.  ``%`` escapes are decoded first and A-Z
    lower-cased; a null or empty URL holds none."""
    weights = tuple(sorted((term.translate(LOWER), weight) for term, weight in vocabulary.items()))
    if any(not term for term, _ in weights):
        raise ValueError("a term is not empty")
    _check_size(sum(len(term) for term, _ in weights))
    kind = pa.struct([("strict", pa.int32()), ("soft", pa.int32()), ("weight", pa.int32())])

    @F.arrow_udf(HITS)
    def hits(urls: pa.Array) -> pa.Array:
        terms = _compiled(weights, limit)
        return pa.array([dict(zip(("strict", "soft", "weight"), terms.hits(u), strict=True)) for u in urls.to_pylist()], kind)

    return hits(url)


def _check_size(characters: int) -> None:
    if characters > MOST_CHARACTERS:
        raise ValueError(f"{characters} characters of terms or rules; up to {MOST_CHARACTERS} go to every task")


def host_of(url: Column) -> Column:
    """From after the first ``://`` to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; empty without one."""
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without a host's ``://``."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(name, verdict) of the longest rule (host and path together) that fits:
    the URL's host is the rule's or a subdomain of it, and its path starts with
    the rule's.  Of equally long ones the longer host decides, then ``block``; null where none fits."""
    _check_size(sum(len(r.name) for r in rules))
    ordered = sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.verdict != "block", r))
    fits = [((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path) for r in ordered]
    kind = "struct<name:string,verdict:string>"
    out = F.lit(None).cast(kind)
    for r, fit in reversed(list(zip(ordered, fits, strict=True))):
        out = F.when(fit, F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def _verdict(rule: Column, hits: Column, limit: int) -> Column:
    return F.coalesce(rule["verdict"], F.when(hits["weight"] >= limit, "block").otherwise("allow"))


def judge_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, vocabulary: Mapping[str, int] = VOCABULARY, limit: int = LIMIT,
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row for each row of ``pages``: id, host, path, the name of the rule
    that fits or null, the verdict, and the numbers of distinct strict and soft terms.

    A null URL, or one without ``://``, has an empty host and path, so that no
    rule fits; a null URL holds no terms and is allowed.  Repeated rows and ids
    each give their row, an empty table none.  Map tasks only."""
    url = F.col(url_col)
    own = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"),
                       vocabulary_hits(url, vocabulary, limit).alias("hits"))
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    return (own.select("page_id", "host", "path", "hits", rule.alias("found"))
            .select("page_id", "host", "path", F.col("found.name").alias("rule"), _verdict(F.col("found"), F.col("hits"), limit).alias("verdict"),
                    F.col("hits.strict").cast("long").alias("n_strict"), F.col("hits.soft").cast("long").alias("n_soft")))


def allowed(pages: DataFrame, rules: Sequence[Rule] = (), vocabulary: Mapping[str, int] = VOCABULARY, limit: int = LIMIT, url_col: str = "url") -> DataFrame:
    """The rows of ``pages`` whose URL is allowed, with all their columns, whatever their names."""
    url = F.col(url_col)
    return pages.where(_verdict(matching_rule(host_of(url), path_of(url), rules), vocabulary_hits(url, vocabulary, limit), limit) == "allow")
