"""URL filters: a bit-parallel automaton that runs all glob rules over each URL at once.

The rules' signs lie side by side in as many 64-bit words as they need. A mask
for each byte says at which places that byte goes on (Shift-And); a star is a
place that stays set whatever byte comes. Urls of a batch advance together, a
byte a step, so a batch costs its longest URL in numpy steps.

A rule (host, path) fits the host and its subdomains and every path that starts
with the rule's: the globs ``host END path*`` and ``*.host END path*`` on the canonical URL
``host END path``, where END is a byte that no text holds, so that no star reaches
from the host into the path. The longest rule that fits decides. Where none fits the method's own globs on
the host decide, and else the URL is allowed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.llm.common import table, utf8

END = b"\xff"
#: verdict, host, path
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Hosts the method blocks where no rule fits.
BLOCKED_HOSTS = ("spam-*", "*.spam-*", "*casino*", "ads.*", "*.ads.*")


class Globs:
    """Glob patterns over bytes as one Shift-And automaton of several machine words.

    ``*`` stands for any bytes, also none; every other byte for itself. Each
    pattern has a start place and a place for each of its bytes; a star makes the
    place before it stay.
    """

    def __init__(self, patterns: list[bytes]):
        places: list[int | None] = []
        stays: list[int] = []
        self.start, self.final = [], []
        for pattern in patterns:
            self.start.append(len(places))
            places.append(None)
            for byte in pattern:
                if byte == ord("*"):
                    stays.append(len(places) - 1)
                else:
                    places.append(byte)
            self.final.append(len(places) - 1)
        self.words = -(-len(places) // 64) if places else 0
        self.bits = {
            byte: self._pack([k for k, p in enumerate(places) if p == byte])
            for byte in {p for p in places if p is not None}
        }
        self.stay, self.begin = self._pack(stays), self._pack(self.start)
        self.table = np.zeros((256, self.words), np.uint64)
        for byte, mask in self.bits.items():
            self.table[byte] = mask

    def _pack(self, places: list[int]) -> np.ndarray:
        out = np.zeros(self.words, np.uint64)
        for k in places:
            out[k // 64] |= np.uint64(1 << (k % 64))
        return out

    def match(self, texts: list[bytes], step: int = 8192) -> np.ndarray:
        """(text, pattern) -> whether the whole text fits the pattern."""
        out = np.zeros((len(texts), len(self.start)), bool)
        for at in range(0, len(texts) if self.words else 0, step):
            out[at : at + step] = self._match(texts[at : at + step])
        return out

    def _match(self, texts: list[bytes]) -> np.ndarray:
        lens = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-lens, kind="stable")
        flat = np.frombuffer(b"".join(texts), np.uint8)
        offset = (np.cumsum(lens) - lens)[order]
        going = np.searchsorted(-lens[order], -np.arange(int(lens.max(initial=0))), "left")
        state = np.repeat(self.begin[None], len(texts), axis=0)
        one, top = np.uint64(1), np.uint64(63)
        for position, alive in enumerate(going.tolist()):
            now = state[:alive]
            moved = now << one
            if self.words > 1:
                moved[:, 1:] |= now[:, :-1] >> top
            moved &= self.table[flat[offset[:alive] + position]]
            state[:alive] = moved | (now & self.stay)
        found = np.empty((len(texts), len(self.final)), bool)
        for k, place in enumerate(self.final):
            found[order, k] = (state[:, place // 64] >> np.uint64(place % 64)) & one != 0
        return found


def parts(url: bytes | None) -> tuple[bytes, bytes]:
    """Host in ASCII lower case, and path, of a URL; both empty without ``://``."""
    head, sep, rest = (url or b"").partition(b"://")
    if not sep:
        return b"", b""
    rest = rest.partition(b"#")[0].partition(b"?")[0]
    host, slash, path = rest.partition(b"/")
    return host.lower(), slash + path


def _literal(text: str) -> bytes:
    if "*" in text:
        raise ValueError("a rule's host and path have no wildcards")
    return text.encode()


def judge(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: tuple[tuple[str, str, str], ...] = RULES,
    blocked_hosts: tuple[str, ...] = BLOCKED_HOSTS,
) -> DataFrame:
    """(id, host, path, rule, verdict) of each row.

    A null or empty URL, or one without ``://``, has an empty host and path, and
    no rule fits it. Of rules of one length the earlier wins. Rows stand for
    themselves, so repeated rows repeat their result; other columns are not read.
    """
    ranked = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    names = [host + path for _, host, path in ranked] + [None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        globs = Globs(
            [p + _literal(host) + END + _literal(path) + b"*" for _, host, path in ranked for p in (b"", b"*.")]
        )
        hosts_of = Globs([h.encode() for h in blocked_hosts])
        said = np.array([r[0] for r in ranked] + [""], object)
        for batch in batches:
            found = [parts(u) for u in utf8(batch.column(1))]
            hosts, paths = [f[0] for f in found], [f[1] for f in found]
            fits = globs.match([h + END + p for h, p in found]).reshape(len(found), -1, 2).any(axis=2)
            first = np.where(fits.any(axis=1), fits.argmax(axis=1), len(ranked)) if len(ranked) else np.zeros(len(found), int)
            own = hosts_of.match(hosts).any(axis=1)
            verdict = np.where(first < len(ranked), said[first], np.where(own, "block", "allow"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([h.decode() for h in hosts], pa.string()),
                    pa.array([p.decode() for p in paths], pa.string()),
                    pa.array([names[k] for k in first.tolist()], pa.string()),
                    pa.array(verdict.tolist(), pa.string()),
                ],
                names=["id", "host", "path", "rule", "verdict"],
            )

    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    kind = pages.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, host string, path string, rule string, verdict string")


def op7_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return judge(table(spark, sf, "pages")).withColumnRenamed("id", "page_id")


SQL = """
with cut as (
  select page_id, case when strpos(url, '://') > 0
                       then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
parted as (
  select page_id, regexp_extract(rest, '^[^/?#]*', 0) as raw_host,
         regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) as path from cut),
hosts as (
  select page_id, path, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host
  from parted),
ruled as (
  select page_id, host, path,
         case when (host = 'example.net' or ends_with(host, '.example.net')) and starts_with(path, '/en/') then 'example.net/en/'
              when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/de/') then 'example.com/de/'
              when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
              when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/') then 'net/' end as rule
  from hosts)
select page_id, host, path, rule,
       case when rule in ('net/', 'example.com/de/') then 'block'
            when rule is not null then 'allow'
            when starts_with(host, 'spam-') or host like '%.spam-%' or host like '%casino%'
                 or starts_with(host, 'ads.') or host like '%.ads.%' then 'block'
            else 'allow' end as verdict
from ruled
"""
