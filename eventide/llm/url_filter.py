"""URL filters: a bit-parallel wildcard automaton over canonical URLs.

All patterns are packed one after another into one bit mask of several 64-bit
words. A pattern of m symbols takes m + 1 bits: its start state and one state
per symbol. Reading byte c of a URL updates all patterns at once:

    D = (shift(D) & STEP[c]) | (D & STAY[c])

STEP[c] has a state's bit if its symbol accepts c; STAY[c] has it if a star
follows the state and may eat c. STEP never has a start bit, so what shifts out
of one pattern does not enter the next. The words of many URLs form a matrix,
which numpy updates for one byte position of all URLs at a time.

Null URLs and URLs without ``://`` have an empty host and path. Repeated rows
are judged one by one; further columns are carried along unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from eventide.llm.common import table, utf8

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the query op1.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)
#: Globs over ``.host/path`` that block a URL which no rule fits. ``*`` stays inside the host or one path part, ``**`` does not.
BLOCK_GLOBS = (
    "*casino*/**", "*adult*/**", "*porn*/**", "*xxx*/**", "*pills*/**", "*-bets*/**", "*spam*/**", "*.ads-*/**", "*.ads.*/**",
    "**/wp-login.php**", "**/phishing/**",
)

_ANY = np.ones(256, bool)
_PART = _ANY.copy()
_PART[ord("/")] = False


def parse_glob(glob: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """Symbols after the start state: (bytes that step in, bytes that a following star may eat)."""
    none = np.zeros(256, bool)
    out, data, i = [(none, none)], glob.encode(), 0
    while i < len(data):
        if data[i : i + 1] == b"*":
            wide = data[i : i + 2] == b"**"
            out[-1] = (out[-1][0], out[-1][1] | (_ANY if wide else _PART))
            i += 2 if wide else 1
            continue
        accept = np.zeros(256, bool)
        if data[i : i + 1] == b"?":
            accept = _PART
        else:
            accept[data[i]] = True
        out.append((accept, none))
        i += 1
    return out


class Automaton:
    """All ``globs`` in one Shift-And automaton."""

    def __init__(self, globs: Sequence[str]) -> None:
        states = [parse_glob(g) for g in globs]
        total = max(1, sum(map(len, states)))
        self.words = -(-total // 64)
        step, stay = np.zeros((256, self.words * 64), bool), np.zeros((256, self.words * 64), bool)
        start = np.zeros((1, self.words * 64), bool)
        self.accept, at = [], 0
        for s in states:
            start[0, at] = True
            for k, (accept, star) in enumerate(s):
                step[:, at + k], stay[:, at + k] = accept, star
            at += len(s)
            self.accept.append(at - 1)
        pack = lambda bits: np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
        self.step, self.stay, self.start = pack(step), pack(stay), pack(start)

    def match(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Boolean matrix: does pattern j match the whole of value i?"""
        lens = np.diff(offsets)
        order = np.argsort(-lens, kind="stable")
        lens, begins = lens[order], offsets[:-1][order]
        d = np.repeat(self.start, len(lens), axis=0)
        one, top = np.uint64(1), np.uint64(63)
        for t in range(int(lens[0]) if len(lens) else 0):
            n = int(np.searchsorted(-lens, -t, side="left"))  # values longer than t come first
            c, live = buf[begins[:n] + t], d[:n]
            shifted = live << one
            shifted[:, 1:] |= live[:, :-1] >> top
            d[:n] = (shifted & self.step[c]) | (live & self.stay[c])
        out = np.empty((len(lens), len(self.accept)), bool)
        for j, bit in enumerate(self.accept):
            out[order, j] = (d[:, bit // 64] >> np.uint64(bit % 64)) & one != 0
        return out


def host_and_path(url):
    """Host (A-Z lower-cased) and path of a URL column; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    empty = url.isNull() | (at == 0)
    return (
        F.when(empty, "").otherwise(F.translate(host, UPPER, LOWER)),
        F.when(empty, "").otherwise(path),
    )


def url_filter(
    pages: DataFrame, rules: Sequence[Rule] = RULES, block_globs: Sequence[str] = BLOCK_GLOBS, default: str = "allow"
) -> DataFrame:
    """Columns of ``pages`` plus host, path, rule and verdict.

    The longest rule that fits decides (equal length: the first in string
    order). Without one, a matching glob blocks and ``default`` holds otherwise.
    An input column with the name of a new one is replaced.
    """
    ranked = sorted(rules, key=lambda r: (-len(r.name), r.name))
    automaton = Automaton([f"*.{r.host}{r.path}**" for r in ranked] + list(block_globs))
    names = pa.array([r.name for r in ranked] + [None], pa.string())
    verdicts = pa.array([r.verdict for r in ranked] + [default, "block"], pa.string())
    host, path = host_and_path(F.col("url"))
    based = pages.withColumns({"host": host, "path": path})
    keep = [c for c in based.columns if c not in ("rule", "verdict")]
    based = based.select(*keep)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(ranked)
        for b in batches:
            canonical = pc.binary_join_element_wise(".", b.column("host").cast(pa.string()), b.column("path").cast(pa.string()), "")
            hit = automaton.match(*utf8(canonical))
            ruled = np.concatenate([hit[:, :k], np.ones((len(hit), 1), bool)], axis=1).argmax(axis=1)
            verdict = np.where(ruled < k, ruled, k + hit[:, k:].any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, names.take(pa.array(ruled)), verdicts.take(pa.array(verdict))], names=[*b.schema.names, "rule", "verdict"]
            )

    return based.mapInArrow(judge, StructType([*based.schema.fields, StructField("rule", StringType()), StructField("verdict", StringType())]))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


_FITS = "(host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}')"
_GLOBS = " OR ".join([
    *[f"(regexp_matches('.' || host, '{g}') AND starts_with(path, '/'))"
      for g in ("casino", "adult", "porn", "xxx", "pills", "-bets", "spam", r"\.ads-", r"\.ads\.")],
    r"contains(path, '/wp-login.php')", r"contains(path, '/phishing/')",
])
ORACLE = rf"""
WITH parts AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
ruled AS (
  SELECT *, CASE
    {" ".join(f"WHEN {_FITS.format(h=r.host, p=r.path)} THEN '{r.name}'" for r in sorted(RULES, key=lambda r: (-len(r.name), r.name)))}
    END AS rule FROM split)
SELECT page_id, host, path, rule, CASE
    {" ".join(f"WHEN rule = '{r.name}' THEN '{r.verdict}'" for r in RULES)}
    WHEN {_GLOBS} THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""
