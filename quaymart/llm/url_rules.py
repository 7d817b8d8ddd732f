"""URL verdicts by a bit-parallel automaton of all glob rules at once.

A glob is literal characters, ``?`` for one character, ``*`` for any run without a slash and
``**`` for any run. All globs are laid out in one row of bits, a bit for every number of
symbols matched so far, over as many 64-bit words as that takes (Shift-And). Two masks per
byte value say which bits move on and which stay (the runs), so one step of a URL is a
shift, two ANDs and an OR whatever the number of rules; a batch of URLs steps together.

A URL is judged by its host (A-Z lower-cased) and path, in canonical form ``host + path``.
The longest fitting host rule wins, then the longest fitting glob, then the default.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

URLS_PER_STEP = 4096
CELLS = 1 << 23
_AUTHORITY = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class HostRule:
    """A verdict for a host and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"

    @property
    def globs(self) -> list[str]:
        return [f"{self.name}**", f"*.{self.name}**"]


#: The production rules, and the globs that judge what no host rule fits.
RULES = (
    HostRule("net", "/", "block"), HostRule("example.net", "/en/", "allow"),
    HostRule("example.com", "/de/", "block"), HostRule("org", "/fr/", "allow"))
GLOBS = tuple((glob, "block") for word in ("cheap-pills", "free-bets", "spam-farm")
              for glob in (f"*{word}*/**", f"*{word}*"))
DEFAULT = "allow"


class Automaton:
    """Masks of all globs: ``move[c]`` and ``stay[c]`` over the words, start and final bits."""

    def __init__(self, globs: Sequence[str]):
        symbols, final, starts, at = [], [], [], 0
        for glob in globs:
            starts.append(at)
            row: list[tuple[str, int]] = []  # (kind, byte) by bit: what leads on, and what stays
            data, i = glob.encode(), 0
            stay = ""
            while i < len(data):
                if data[i:i + 2] == b"**":
                    stay, i = "any", i + 2
                elif data[i:i + 1] == b"*":
                    stay, i = stay or "run", i + 1
                else:
                    row.append(("one" if data[i:i + 1] == b"?" else "byte", data[i], stay))
                    stay, i = "", i + 1
            row.append(("end", 0, stay))
            symbols += row
            at += len(row)
            final.append(at - 1)
        self.words = -(-max(at, 1) // 64)
        bits_move = np.zeros((256, self.words * 64), dtype=bool)
        bits_stay = np.zeros_like(bits_move)
        for bit, (kind, byte, stay) in enumerate(symbols):
            if kind == "byte":
                bits_move[byte, bit] = True
            elif kind == "one":
                bits_move[:, bit] = True
            if stay:
                bits_stay[:, bit] = True
            if stay == "run":
                bits_stay[ord("/"), bit] = False
        self.move, self.stay = self._packed(bits_move), self._packed(bits_stay)
        begin = np.zeros((1, self.words * 64), dtype=bool)
        begin[0, starts] = True
        self.begin = self._packed(begin)[0]
        self.final = np.array(final, dtype=np.int64)

    def _packed(self, bits: np.ndarray) -> np.ndarray:
        return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).reshape(len(bits), self.words)

    def fits(self, texts: list[bytes]) -> np.ndarray:
        """Which globs fit each whole text: a matrix of texts by globs."""
        lengths = np.array([len(x) for x in texts])
        order = np.argsort(-lengths, kind="stable")
        if len(texts) > 1 and len(texts) * lengths.max() > CELLS:  # very long urls: few at a time
            out = np.zeros((len(texts), len(self.final)), dtype=bool)
            for half in np.array_split(order, 2):
                out[half] = self.fits([texts[i] for i in half])
            return out
        matrix = np.zeros((len(texts), max(1, lengths.max(initial=0))), dtype=np.uint8)
        for row, number in enumerate(order):
            matrix[row, :lengths[number]] = np.frombuffer(texts[number], dtype=np.uint8)
        active = np.searchsorted(-lengths[order], -np.arange(matrix.shape[1]), side="left")
        state = np.tile(self.begin, (len(texts), 1))
        one, top = np.uint64(1), np.uint64(63)
        for place in range(matrix.shape[1]):
            live = int(active[place])  # texts longer than this place
            if not live:
                break
            byte, now = matrix[:live, place], state[:live]
            moving = now & self.move[byte]
            shifted = moving << one
            shifted[:, 1:] |= moving[:, :-1] >> top
            state[:live] = shifted | (now & self.stay[byte])
        bits = (state[:, self.final // 64] >> (self.final % 64).astype(np.uint64)) & one
        out = np.zeros(bits.shape, dtype=bool)
        out[order] = bits.astype(bool)
        return out


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path; both empty without ``://``."""
    text = F.coalesce(url, F.lit(""))
    upper = "".join(map(chr, range(65, 91)))
    host = F.translate(F.regexp_extract(text, _AUTHORITY, 1), upper, upper.lower())
    return host, F.regexp_extract(text, _AUTHORITY, 2)


def _judged(rules: Sequence[HostRule], globs: Sequence[tuple[str, str]], default: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [glob for rule in rules for glob in rule.globs]
        automaton = Automaton([*names, *[glob for glob, _ in globs]])
        # Longest first, the first listed among equals.
        by_rule = sorted(range(len(rules)), key=lambda i: (-len(rules[i].name), i))
        by_glob = sorted(range(len(globs)), key=lambda i: (-len(globs[i][0]), i))
        for batch in batches:
            for at in range(0, batch.num_rows, URLS_PER_STEP):
                part = batch.slice(at, URLS_PER_STEP)
                texts = [(h + p).encode() for h, p in zip(
                    part.column("host").to_pylist(), part.column("path").to_pylist(), strict=True)]
                fits = automaton.fits(texts)
                ruled = fits[:, :len(names)].reshape(len(texts), len(rules), 2).any(axis=2)
                rule, glob, verdict = [], [], []
                for row in range(len(texts)):
                    first = next((i for i in by_rule if ruled[row, i]), None)
                    second = next((i for i in by_glob if fits[row, len(names) + i]), None)
                    rule.append(None if first is None else rules[first].name)
                    glob.append(None if second is None else globs[second][0])
                    verdict.append(rules[first].verdict if first is not None
                                   else globs[second][1] if second is not None else default)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in ("page_id", "host", "path")],
                     *[pa.array(x, pa.string()) for x in (rule, verdict, glob)]],
                    ["page_id", "host", "path", "rule", "verdict", "glob"])
    return run


def judge(
    pages: DataFrame, *, rules: Sequence[HostRule] = RULES, globs: Sequence[tuple[str, str]] = GLOBS,
    default: str = DEFAULT,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, glob) of every row.

    A null url, or one without ``://``, has empty host and path and gets the default unless a
    glob fits the empty text. Ids are passed on as they are; other columns are not read.
    """
    host, path = host_and_path(F.col("url"))
    return pages.select("page_id", host.alias("host"), path.alias("path")).mapInArrow(
        _judged(tuple(rules), tuple(globs), default),
        "page_id bigint, host string, path string, rule string, verdict string, glob string")


#: The same verdicts in DuckDB's SQL.
ORACLE = """
WITH p AS (SELECT page_id, lower(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's')) AS host,
                  regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path FROM pages),
r AS (SELECT page_id, host, path, CASE
        WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule,
      CASE WHEN host LIKE '%cheap-pills%' THEN '*cheap-pills*' WHEN host LIKE '%free-bets%' THEN '*free-bets*'
           WHEN host LIKE '%spam-farm%' THEN '*spam-farm*' END || CASE WHEN path <> '' THEN '/**' ELSE '' END AS "glob"
      FROM p)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN "glob" IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict, "glob"
FROM r"""
