"""URL filters: all wildcard rules run at once as one bit-parallel automaton over each canonical URL.

A rule is a glob over ``host + path``. ``*`` stands for any run without a slash, ``**`` for any run. Each rule takes one bit
per literal character and a start bit; all rules lie side by side in 64-bit words, and every character of a URL
moves the states of all of them with one shift, one mask and one loop for the wildcards.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstream.llm.common import bytes_of

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class SiteRule:
    """``name`` is a host and the start of a path; it fits the host, its subdomains, and paths that start so."""

    name: str
    verdict: str

    def globs(self) -> tuple[str, str]:
        return f"{self.name}**", f"*.{self.name}**"


#: Fixed by the query's contract.
SITE_RULES = (
    SiteRule("net/", BLOCK),
    SiteRule("example.net/en/", ALLOW),
    SiteRule("example.com/de/", BLOCK),
    SiteRule("org/fr/", ALLOW),
)
#: Pages that no site rule fits are blocked if one of these does, and allowed otherwise.
BLOCK_GLOBS = (
    "**casino**",
    "**free-bets**",
    "**cheap-pills**",
    "**spam-farm**",
    "adult-*.*/**",
    "*.adult-*.*/**",
    "ads-*.*/**",
    "*.ads-*.*/**",
)


class Automaton:
    """Shift-And over many globs. ``matches`` gives a bit for each glob and text."""

    def __init__(self, globs: Sequence[str]) -> None:
        bits = 0
        literal: list[tuple[int, int]] = []  # (bit, byte) that reaches it
        loops_any: list[int] = []
        loops_segment: list[int] = []
        starts: list[int] = []
        self.finals: list[int] = []
        for glob in globs:
            starts.append(bits)
            for piece in re.findall(rb"\*\*|\*|[^*]", glob.encode()):
                if piece == b"**":
                    loops_any.append(bits)
                elif piece == b"*":
                    loops_segment.append(bits)
                else:
                    bits += 1
                    literal.append((bits, piece[0]))
            self.finals.append(bits)
            bits += 1
        self.words = max(1, -(-bits // 64))
        self.begin = self._mask(starts)
        self.reach = np.zeros((256, self.words), np.uint64)
        for bit, byte in literal:
            self.reach[byte, bit >> 6] |= np.uint64(1) << np.uint64(bit & 63)
        self.stay = np.repeat(self._mask(loops_any + loops_segment)[None], 256, axis=0)
        self.stay[ord("/")] = self._mask(loops_any)

    def _mask(self, bits: list[int]) -> np.ndarray:
        mask = np.zeros(self.words, np.uint64)
        for bit in bits:
            mask[bit >> 6] |= np.uint64(1) << np.uint64(bit & 63)
        return mask

    def matches(self, texts: list[bytes]) -> np.ndarray:
        """Boolean array of texts by globs; whole texts have to match."""
        out = np.zeros((len(texts), len(self.finals)), bool)
        if not texts:
            return out
        # longest first, so that the texts still running are always the first rows
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(-lengths, kind="stable")
        joined = np.frombuffer(b"".join(texts), np.uint8)
        offset = (np.cumsum(lengths) - lengths)[order]
        running = lengths[order]
        state = np.repeat(self.begin[None], len(texts), axis=0)
        for at in range(int(running[0])):
            n = int(np.searchsorted(-running, -at, side="left"))
            byte = joined[offset[:n] + at]
            now = state[:n]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:n] = (moved & self.reach[byte]) | (now & self.stay[byte])
        for k, bit in enumerate(self.finals):
            out[order, k] = (state[:, bit >> 6] >> np.uint64(bit & 63)) & np.uint64(1) == 1
        return out


def _with_host_and_path(pages: DataFrame) -> DataFrame:
    """``(page_id, host, path)``; both empty without ``://``."""
    rest = F.regexp_extract(F.coalesce("url", F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(
        F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        host.alias("host"),
        F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1).alias("path"),
    )


def judge(
    pages: DataFrame, site_rules: Sequence[SiteRule] = SITE_RULES, block_globs: Sequence[str] = BLOCK_GLOBS
) -> DataFrame:
    """``(page_id, host, path, rule, verdict)``, one row for each row of ``pages``.

    The longest site rule that fits decides, by its name; without one, ``block_globs`` do. A null or empty url, or one
    without ``://``, has an empty host and path: no rule fits and it is allowed. Null ids and repeated rows are
    judged like others; other columns are not read. An empty table gives no rows.
    """
    globs = [g for rule in site_rules for g in rule.globs()] + list(block_globs)
    n_site = 2 * len(site_rules)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(globs)
        order = sorted(range(len(site_rules)), key=lambda k: -len(site_rules[k].name))
        for batch in batches:
            hosts, paths = bytes_of(batch.column("host")), bytes_of(batch.column("path"))
            hits = automaton.matches([h + p for h, p in zip(hosts, paths, strict=True)])
            fits = hits[:, 0:n_site:2] | hits[:, 1:n_site:2]
            chosen = [next((k for k in order if row[k]), None) for row in fits]
            listed = hits[:, n_site:].any(axis=1)
            names = [None if k is None else site_rules[k].name for k in chosen]
            verdicts = [
                (BLOCK if listed[i] else ALLOW) if k is None else site_rules[k].verdict for i, k in enumerate(chosen)
            ]
            yield pa.record_batch(
                [*(batch.column(c) for c in ("page_id", "host", "path")), pa.array(names, pa.string()), pa.array(verdicts, pa.string())],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    schema = "page_id long, host string, path string, rule string, verdict string"
    return _with_host_and_path(pages.select("page_id", "url")).mapInArrow(run, schema)


def judge_sql() -> str:
    """``judge`` for DuckDB, rule by rule."""

    def pattern(glob: str) -> str:
        parts = [{"**": ".*", "*": "[^/]*"}.get(x) or re.escape(x) for x in re.findall(r"\*\*|\*|[^*]+", glob)]
        return "".join(parts).replace("'", "''")

    def any_of(globs: Sequence[str]) -> str:
        return " OR ".join(f"regexp_full_match(host || path, '{pattern(g)}', 's')" for g in globs)

    ranked = sorted(SITE_RULES, key=lambda r: -len(r.name))
    rule = " ".join(f"WHEN {any_of(r.globs())} THEN '{r.name}'" for r in ranked)
    verdict = " ".join(f"WHEN rule = '{r.name}' THEN '{r.verdict}'" for r in ranked)
    return f"""
WITH rest AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
ruled AS (SELECT *, CASE {rule} END AS rule FROM parts)
SELECT page_id, host, path, rule, CASE {verdict} WHEN {any_of(BLOCK_GLOBS)} THEN '{BLOCK}' ELSE '{ALLOW}' END AS verdict FROM ruled"""
