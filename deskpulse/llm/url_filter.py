"""URL verdicts by a bit-parallel wildcard automaton (operator 9).

Method: all glob rules are packed one behind the other into the bits of a
few 64-bit words (Shift-And). A rule with literal characters c1..cm owns the
states 0..m; ``*`` becomes a self-loop on the state before it; every other
character, ``?`` included, stands for itself. One pass over the bytes of a canonical URL moves all states of all
rules at once: ``D = ((D << 1) & mask[byte]) | (D & loops)``; the final
states that are set at the end of the URL are the rules that match. The pass
runs over many URLs at a time in numpy, sorted by length, so every URL costs
its own length only. The masks (256 x words) and the rule list are the only
state; they are bounded by the rules, not by the data.

Canonical URL: ``.host?path`` with the host lower-cased. A host has no ``?``, so
``*.example.com?/en/*`` holds for example.com and its subdomains and paths
that start with /en/, and for nothing else.

Verdict: the longest (host + path) site rule that fits decides; without one,
the block globs (the method's own rules) decide; otherwise allow.

Defined cases: a null URL or one without ``://`` has an empty host and path,
no rule, and is allowed; repeated rows each get their verdict; very long URLs
are processed whole; an empty table gives no rows; other columns are kept out
of the way and returned untouched by ``judge_urls``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskpulse.llm.io import table
from deskpulse.llm.textvec import arrow_buffers

#: (verdict, host, path) of the contract's rules.
SITE_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: Globs over the canonical URL that block where no site rule fits.
BLOCK_GLOBS = [
    ".spam-*", "*.spam-*", "*spam-farm.*", "*.cheap-*", "*-pills.*", "*casino*?*", "*.porn*?*", "*.xxx?*", "*free-money*", "*?*.exe", "*?*/phishing/*",
]
ROWS = 4096  # URLs per numpy step
WIDE = 1 << 22  # bytes of one padded block of URLs


class Automaton:
    """Shift-And over several words for a list of globs, anchored at both ends."""

    def __init__(self, globs: list[str]):
        bits, self.finals = [], []  # per state: the set of bytes that enters it, whether it loops
        start = []
        for g in globs:
            first = len(bits)
            bits.append([None, False])  # state 0 of the rule is entered by no byte
            start.append(first)
            for c in g.encode():
                if c == ord("*"):
                    bits[-1][1] = True
                else:
                    bits.append([c, False])
            self.finals.append(len(bits) - 1)
        self.words = -(-len(bits) // 64)
        one = lambda at: (at // 64, np.uint64(1) << np.uint64(at % 64))
        self.enter = np.zeros((256, self.words), np.uint64)
        self.loop = np.zeros(self.words, np.uint64)
        self.first = np.zeros(self.words, np.uint64)
        for at, (c, loops) in enumerate(bits):
            w, b = one(at)
            if c is not None:
                self.enter[c, w] |= b
            if loops:
                self.loop[w] |= b
        for at in start:
            w, b = one(at)
            self.first[w] |= b

    def run(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(texts, globs) booleans: which glob matches which whole text."""
        n = len(offsets) - 1
        lens = np.diff(offsets)
        out = np.zeros((n, len(self.finals)), bool)
        order = lens.argsort(kind="stable")
        at = 0
        while at < n:
            rows = order[at : at + ROWS]
            while len(rows) > 1 and len(rows) * int(lens[rows[-1]]) > WIDE:
                rows = rows[: len(rows) // 2]
            out[rows] = self._block(data, offsets[rows], lens[rows])
            at += len(rows)
        return out

    def _block(self, data, begins, lens):
        state = np.tile(self.first, (len(begins), 1))
        live = 0  # rows are sorted by length; those before it have ended
        for k in range(int(lens[-1]) if len(lens) else 0):
            while lens[live] <= k:
                live += 1
            s = state[live:]
            moved = s << np.uint64(1)
            moved[:, 1:] |= s[:, :-1] >> np.uint64(63)
            moved &= self.enter[data[begins[live:] + k]]
            state[live:] = moved | (s & self.loop)
        f = np.array(self.finals)
        return (state[:, f // 64] >> (f % 64).astype(np.uint64) & np.uint64(1)).astype(bool)


def site_glob(host: str, path: str) -> str:
    return f"*.{host}?{path}*"


def judge_urls(pages: DataFrame, url_col: str = "url", site_rules=SITE_RULES, block_globs=BLOCK_GLOBS) -> DataFrame:
    """``pages`` plus ``judged`` = struct(host, path, rule, verdict)."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    longest = sorted(range(len(site_rules)), key=lambda i: -len(site_rules[i][1] + site_rules[i][2]))
    globs = [site_glob(site_rules[i][1], site_rules[i][2]) for i in longest] + list(block_globs)

    @F.pandas_udf("int")
    def which(c):
        hits = Automaton(globs).run(*arrow_buffers(pa.array(c, pa.large_string())))
        return pd.Series(np.where(hits.any(1), hits.argmax(1), -1))

    names = F.array(*[F.lit(site_rules[i][1] + site_rules[i][2]) for i in longest])
    verdicts = F.array(*[F.lit(site_rules[i][0]) for i in longest])
    parts = F.struct(host.alias("host"), path.alias("path"))
    n = len(longest)
    out = pages.withColumn("judged", parts)
    hit = which(F.concat(F.lit("."), F.col("judged.host"), F.lit("?"), F.col("judged.path")))
    out = out.withColumn("judged", F.struct("judged.host", "judged.path", hit.alias("hit")))
    at = F.col("judged.hit")
    rule = F.when(at.between(0, n - 1), F.get(names, at))
    verdict = F.when(at.between(0, n - 1), F.get(verdicts, at)).when(at >= n, "block").otherwise("allow")
    return out.withColumn("judged", F.struct("judged.host", "judged.path", rule.alias("rule"), verdict.alias("verdict")))


def op9_url_filter(spark, sf_dir: str) -> DataFrame:
    """Contract query over all pages."""
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "judged.*")


def _like(glob: str) -> str:
    return "'" + glob.replace("!", "!!").replace("%", "!%").replace("_", "!_").replace("*", "%").replace("'", "''") + "' ESCAPE '!'"


def op9_sql() -> str:
    """DuckDB statement of the same verdicts (LIKE for the block globs)."""
    fits = " ".join(
        f"WHEN '.' || host LIKE {_like('*.' + h)} AND starts_with(path, '{p}') THEN '{h}{p}'"
        for _, h, p in sorted(SITE_RULES, key=lambda r: -len(r[1] + r[2]))
    )
    says = " ".join(f"WHEN '{h}{p}' THEN '{v}'" for v, h, p in SITE_RULES)
    blocked = " OR ".join(f"canon LIKE {_like(g)}" for g in BLOCK_GLOBS)
    return f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), ruled AS (
  SELECT *, '.' || host || '?' || path AS canon, CASE {fits} END AS rule FROM parts
)
SELECT page_id, host, path, rule,
       CASE rule {says} ELSE CASE WHEN {blocked} THEN 'block' ELSE 'allow' END END AS verdict
FROM ruled
"""
