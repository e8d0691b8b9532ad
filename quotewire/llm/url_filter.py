"""URL filters: rules by host and path, then a weighted vocabulary found by Aho-Corasick."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Distinct soft terms that reject a url.
SOFT_LIMIT = 2
#: Rules and terms one automaton may hold; both travel to every task.
MAX_ENTRIES = 1_000_000

#: (host and path, verdict) of the rules.
RULES = [
    ("org/", ALLOW),
    ("example.org/es/", BLOCK),
    ("example.org/en/1", BLOCK),
    ("com/fr/", ALLOW),
    ("com/de/", BLOCK),
]
#: One of these rejects a url.
STRICT = [
    "adult", "betting", "camgirls", "casino", "casinos", "cialis", "escort", "escorts", "gambling",
    "hentai", "keygen", "malware", "milf", "nude", "nudes", "phishing", "poker", "porn", "porno",
    "sex", "sexcam", "slots", "spam", "viagra", "warez", "webcam-girls", "xxx",
]
#: Several of these together do.
SOFT = [
    "ads", "adult-chat", "bargain", "bet", "bets", "bingo", "bonus", "cash", "cheap", "click", "clicks",
    "coupon", "crack", "credit", "dating", "deal", "deals", "discount", "doubleclick", "download",
    "farm", "free", "jackpot", "loan", "loans", "lottery", "lucky", "meds", "miracle", "pharma",
    "pharmacy", "pills", "popup", "prize", "promo", "replica", "seo", "singles", "steroids", "torrent",
    "track", "tracker", "tracking", "weight-loss", "win", "winner",
]
RESULT = "struct<rule:string,rule_verdict:string,strict_hits:array<string>,soft_hits:array<string>>"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A to Z lower-cased, and path of a url; both empty without a ``://``.

    The host reaches from the first ``://`` to the next ``/``, ``?`` or ``#``, so a port or
    a user name belongs to it; the path from there to the next ``?`` or ``#``.
    """
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda i: F.coalesce(F.regexp_extract(url, pattern, i), F.lit(""))
    return F.translate(part(1), CAPITALS, SMALL), part(2)


class Rules:
    """The longest rule that fits: its host or a subdomain of it, and the start of the path."""

    def __init__(self, rules: Iterable[tuple[str, str]]):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for text, verdict in rules:
            host, slash, rest = text.partition("/")
            self.by_host.setdefault(host, []).append((slash + rest, text, verdict))

    def find(self, host: str, path: str) -> tuple[str | None, str | None]:
        best, verdict, at = None, None, 0
        while host and at >= 0:
            for start, text, says in self.by_host.get(host[at:], ()):
                if path.startswith(start) and (best is None or len(text) > len(best)):
                    best, verdict = text, says
            at = host.find(".", at) + 1 or -1
        return best, verdict


def _inside_word(char: str) -> bool:
    return char >= "\x80" or "a" <= char <= "z" or "0" <= char <= "9"


class Vocabulary:
    """Terms with a class each, found in one pass over a text by an Aho-Corasick automaton."""

    def __init__(self, strict: Iterable[str], soft: Iterable[str]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for terms, is_strict in ((soft, False), (strict, True)):
            for term in terms:
                self.automaton.add_word(term, (term, is_strict))
        if len(self.automaton):
            self.automaton.make_automaton()

    def hits(self, text: str) -> tuple[list[str], list[str]]:
        """Distinct strict and soft terms of a lower-cased text, by name.

        A term counts where no letter or digit stands at either side; all that is not ASCII
        counts as a letter. Terms may overlap.
        """
        found: tuple[set, set] = (set(), set())
        if len(self.automaton):
            for end, (term, is_strict) in self.automaton.iter(text):
                before, after = end - len(term), end + 1
                if before >= 0 and _inside_word(text[before]):
                    continue
                if after < len(text) and _inside_word(text[after]):
                    continue
                found[not is_strict].add(term)
        return sorted(found[0]), sorted(found[1])


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, strict: Sequence[str] = STRICT,
    soft: Sequence[str] = SOFT, soft_limit: int = SOFT_LIMIT,
) -> DataFrame:
    """``pages`` with host, path, rule, verdict, strict_hits and soft_hits of every url.

    The verdict is that of the longest rule (host and start of a path) that fits the url's
    host, or one it is a subdomain of, and its path; else ``block`` where the url holds a
    strict term or ``soft_limit`` distinct soft ones, else ``allow``. Hits are told whether
    or not a rule decides. Rules and terms are lower-case; of equal rules the first counts.

    A null url, and one without ``://``, has an empty host and path, so no rule fits; a
    null one holds no terms. Columns of ``pages`` with a result's name are replaced, others
    stay as they are; rows may repeat. Rules and vocabulary travel with the plan and are
    limited to ``MAX_ENTRIES``. No row leaves its task.
    """
    if len(rules) + len(strict) + len(soft) > MAX_ENTRIES:
        raise ValueError(f"over {MAX_ENTRIES} rules and terms")
    rules, strict, soft = list(rules), list(strict), list(soft)

    def look(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        known, words = Rules(rules), Vocabulary(strict, soft)
        kind = pa.struct([
            ("rule", pa.string()), ("rule_verdict", pa.string()),
            ("strict_hits", pa.list_(pa.string())), ("soft_hits", pa.list_(pa.string())),
        ])
        for urls, hosts, paths in batches:
            out = []
            for url, host, path in zip(urls.to_pylist(), hosts.to_pylist(), paths.to_pylist()):
                rule, says = known.find(host, path)
                hard, mild = words.hits(url or "")
                out.append({"rule": rule, "rule_verdict": says, "strict_hits": hard, "soft_hits": mild})
            yield pa.array(out, kind)

    looked_up = F.arrow_udf(look, RESULT)
    host, path = host_and_path(F.col("url"))
    found = looked_up(F.translate("url", CAPITALS, SMALL), host, path)
    bad = (F.size(found["strict_hits"]) > 0) | (F.size(found["soft_hits"]) >= soft_limit)
    results = {
        "host": host, "path": path, "rule": found["rule"],
        "verdict": F.coalesce(found["rule_verdict"], F.when(bad, BLOCK).otherwise(ALLOW)),
        "strict_hits": found["strict_hits"], "soft_hits": found["soft_hits"],
    }
    return pages.withColumns(results)
