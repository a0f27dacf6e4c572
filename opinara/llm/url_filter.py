"""URL filters: rules for hosts and paths, and a weighted vocabulary for the rest.

One Aho-Corasick automaton holds all terms and scans each URL once. A hit counts only
between boundaries. One strict term rejects a URL; soft terms reject it when the weights
of the distinct ones found reach a limit. There is no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from opinara.llm.common import add_column

URL_TYPE = (
    "struct<host: string, path: string, rule: string, verdict: string, strict: array<string>, soft: array<string>,"
    " n_hits: bigint>"
)

_URL_ARROW = pa.struct(
    [
        ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("verdict", pa.string()),
        ("strict", pa.list_(pa.string())), ("soft", pa.list_(pa.string())), ("n_hits", pa.int64()),
    ]
)

_LOWER = {c: c + 32 for c in range(65, 91)}
_PARTS = re.compile(r"://([^/?#]*)([^?#]*)")
_ESCAPE = re.compile("%[0-9a-f]{2}")


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str = ""


#: Terms that reject a URL by themselves, and terms that do so only together.
STRICT_TERMS = ("adult", "casino", "escorts", "hentai", "porn", "sex", "viagra", "warez", "xxx")
SOFT_TERMS = {
    term: 1.0
    for term in (
        "ads bet bets cheap click crack dating deal deals farm free hack hot keygen loan loans lottery nude pharmacy"
        " pill pills poker popunder promo spam torrent track tracker win winner"
    ).split()
}


def _is_word(c: str) -> bool:
    return "0" <= c <= "9" or "a" <= c <= "z" or c > "\x7f"


def _hits(machine, url: str) -> Iterator[str]:
    """Terms of a lower-cased URL that have no letter or digit on either side; escapes are boundaries."""
    scanned = _ESCAPE.sub("   ", url)
    for end, term in machine.iter(scanned):
        start = end - len(term) + 1
        if (start == 0 or not _is_word(scanned[start - 1])) and (end + 1 == len(scanned) or not _is_word(scanned[end + 1])):
            yield term


def _longest_rule(rules: dict[str, list[Rule]], host: str, path: str) -> Rule | None:
    found = []
    at = 0
    while True:
        found += [r for r in rules.get(host[at:], ()) if path.startswith(r.path)]
        dot = host.find(".", at)
        if dot < 0:
            break
        at = dot + 1
    return max(found, key=lambda r: (len(r.host) + len(r.path), len(r.host), r.verdict == "block"), default=None)


def filter_urls(
    pages: DataFrame, rules: Sequence[Rule] = (), strict: Sequence[str] = STRICT_TERMS,
    soft: Mapping[str, float] = SOFT_TERMS, limit: float = 2.0, url: str = "url", out: str = "url_filter",
) -> DataFrame:
    """All rows of pages with struct(host, path, rule, verdict, strict, soft, n_hits) in `out`.

    Host: what follows the first "://" up to "/", "?", "#" or the end, with A-Z lower-cased;
    path: what then follows up to "?", "#" or the end. A rule (allow or block) fits its host
    and all subdomains, if the path starts with the rule's; the longest one decides, of equal
    ones that with the longer host, then block. A URL that no rule fits is blocked by one
    strict term or by soft terms whose weights, each term once, add up to `limit`, anywhere
    in the URL; otherwise it is allowed. `strict` and `soft` list the distinct terms found,
    `n_hits` counts all hits, also where a rule decides.

    Null and empty URLs and those without "://" have an empty host and path, so that no rule
    fits them; the vocabulary is still searched in the whole text. Empty terms never hit; a
    term in both lists is strict. Repeated rows stay, an empty table gives no rows, a column
    named as `out` is replaced. Rules and terms are the caller's lists, sent to the tasks.
    """
    by_host: dict[str, list[Rule]] = {}
    for rule in rules:
        rule = Rule(rule.verdict, rule.host.translate(_LOWER), rule.path)
        by_host.setdefault(rule.host, []).append(rule)
    hard = {t.translate(_LOWER) for t in strict} - {""}
    weights = {t.translate(_LOWER): w for t, w in soft.items() if t and t.translate(_LOWER) not in hard}

    def judge(machine, text: str) -> dict:
        parts = _PARTS.search(text)
        host, path = (parts[1].translate(_LOWER), parts[2]) if parts else ("", "")
        rule = _longest_rule(by_host, host, path)
        hits = list(_hits(machine, text.translate(_LOWER))) if hard or weights else []
        found = sorted(set(hits))
        one, several = [t for t in found if t in hard], [t for t in found if t in weights]
        rejected = bool(one) or sum(weights[t] for t in several) >= limit
        return {
            "host": host, "path": path, "rule": rule and rule.host + rule.path,
            "verdict": rule.verdict if rule else "block" if rejected else "allow",
            "strict": one, "soft": several, "n_hits": len(hits),
        }

    def build():
        machine = ahocorasick.Automaton()
        for term in (*hard, *weights):
            machine.add_word(term, term)
        machine.make_automaton()

        def compute(batch: pa.RecordBatch) -> pa.Array:
            return pa.array([judge(machine, u or "") for u in batch.column(0).to_pylist()], _URL_ARROW)

        return compute

    return add_column(pages, out, URL_TYPE, build, [url])
