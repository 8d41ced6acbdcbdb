"""Judge urls by a sorted array of rule digests.

The rules' 64-bit digests lie sorted in one file with the rules' full strings
behind them. Every task maps that file into memory, so workers of a machine
share its pages, and probes it with a binary search over all candidates of a
batch at once: each host suffix and each path prefix of a url that is as long
as that of some rule. A digest that is found counts only if the stored string is equal
as well. The file goes to executors through Spark's file distribution, from the
shared folder.

Defined cases: a url that is null or has no ``://`` has empty host and path; no
rule then fits. Of several rules that fit, the longest string wins, of equally
long ones the one with the longer host. Without a fitting rule the verdict is
``default`` (allow: the list names exceptions only). Repeated rules count once;
repeated urls are judged one by one. No rules at all: every url gets the default.
"""

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import read_table
from ledgerloom.session import scratch_folder

# (host, path, verdict), fixed by the contract.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
AUTHORITY = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
# Digests probed at once.
PROBES = 200_000


def rule_file(rules) -> bytes:
    """Sorted digests, string starts, verdicts, path lengths and strings, one behind the other.

    Header: numbers of rules, of path lengths and of host lengths, bytes of strings (int64).
    A rule's string is host + a zero byte + path, so hosts and paths cannot mix.
    """
    verdicts = {}
    for host, path, verdict in rules:
        verdicts[f"{host.lower()}\0{path}".encode()] = verdict == "block"
    keys = sorted(verdicts, key=lambda k: (xxhash.xxh64_intdigest(k), k))
    digests = np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64)
    starts = np.cumsum([0, *map(len, keys)]).astype(np.int64)
    # Prefixes are cut from paths as characters, hence lengths in characters.
    lengths = np.unique([len(k.split(b"\0", 1)[1].decode()) for k in keys]).astype(np.int64)
    hosts = np.unique([len(k.split(b"\0", 1)[0].decode()) for k in keys]).astype(np.int64)
    blocked = np.array([verdicts[k] for k in keys], np.int64)
    head = np.array([len(keys), len(lengths), len(hosts), starts[-1]], np.int64)
    arrays = (head, digests, starts, blocked, lengths, hosts)
    return b"".join([*(a.tobytes() for a in arrays), *keys])


class RuleArray:
    """The mapped file and its binary search."""

    def __init__(self, path):
        words = np.memmap(path, np.int64, "r", shape=(4,))
        n, m, h, size = (int(x) for x in words)
        at = 32
        self.digests = self._part(path, np.uint64, at, n)
        self.starts = self._part(path, np.int64, at + 8 * n, n + 1)
        self.blocked = self._part(path, np.int64, at + 16 * n + 8, n)
        self.lengths = self._part(path, np.int64, at + 24 * n + 8, m)
        self.hosts = self._part(path, np.int64, at + 24 * n + 8 + 8 * m, h)
        self.strings = self._part(path, np.uint8, at + 24 * n + 8 + 8 * (m + h), size)

    @staticmethod
    def _part(path, kind, at, count):
        return np.memmap(path, kind, "r", at, (count,)) if count else np.zeros(0, kind)

    def find(self, keys):
        """Index of each key among the rules, or -1."""
        probes = np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64)
        where = np.searchsorted(self.digests, probes)
        found = np.full(len(keys), -1)
        inside = np.flatnonzero(where < len(self.digests))
        for i in inside[self.digests[where[inside]] == probes[inside]]:
            # Colliding digests lie next to each other: confirm by string.
            j = int(where[i])
            while j < len(self.digests) and self.digests[j] == probes[i]:
                if self.strings[self.starts[j] : self.starts[j + 1]].tobytes() == keys[i]:
                    found[i] = j
                    break
                j += 1
        return found

    def rule(self, j):
        return self.strings[self.starts[j] : self.starts[j + 1]].tobytes().decode()


def candidates(host, path, host_lengths, path_lengths):
    """Rule strings that could fit: whole labels at the host's end and starts of the path, of lengths rules have.

    However long a url is, what is cut from it is no longer than the rules.
    """
    for h in host_lengths:
        if h == len(host) or (0 < h < len(host) and host[-h - 1] == "."):
            suffix = host[len(host) - h :]
            for n in path_lengths:
                if n <= len(path):
                    yield f"{suffix}\0{path[:n]}".encode()


def judge(rules: RuleArray, hosts, paths, default):
    best = [(-1, -1, -1)] * len(hosts)
    lengths = rules.hosts.tolist(), rules.lengths.tolist()

    def probe(keys, owners):
        for owner, j in zip(owners, rules.find(keys)):
            if j >= 0:
                host, path = rules.rule(j).split("\0", 1)
                best[owner] = max(best[owner], (len(host) + len(path), len(host), int(j)))

    keys, owners = [], []
    for i, (host, path) in enumerate(zip(hosts, paths)):
        for key in candidates(host, path, *lengths):
            keys.append(key)
            owners.append(i)
        if len(keys) >= PROBES:
            probe(keys, owners)
            keys, owners = [], []
    probe(keys, owners)
    names = [rules.rule(j).replace("\0", "") if j >= 0 else None for _, _, j in best]
    verdicts = [("block" if rules.blocked[j] else "allow") if j >= 0 else default for _, _, j in best]
    return names, verdicts


def share_rules(spark, rules) -> str:
    """Put the rule file into the shared folder and hand it to all executors; its name there."""
    name = f"rules-{uuid.uuid4().hex}.bin"
    target = f"{scratch_folder(spark)}/{name}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(rule_file(rules)))
    out.close()
    spark.sparkContext.addFile(str(path.toString()))
    return name


def judge_urls(pages: DataFrame, rules=RULES, default="allow") -> DataFrame:
    """page_id, host, path, rule and verdict of every row of page_id, url."""
    name = share_rules(pages.sparkSession, rules)

    def work(batches):
        mapped = RuleArray(SparkFiles.get(name))
        for batch in batches:
            hosts, paths = batch.column("host"), batch.column("path")
            names, verdicts = judge(mapped, hosts.to_pylist(), paths.to_pylist(), default)
            names, verdicts = pa.array(names, pa.string()), pa.array(verdicts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), hosts, paths, names, verdicts],
                ["page_id", "host", "path", "rule", "verdict"],
            )

    url = F.coalesce("url", F.lit(""))
    host = F.translate(F.regexp_extract(url, AUTHORITY, 1), UPPER, LOWER)
    parts = pages.select(
        "page_id", host.alias("host"), F.regexp_extract(url, PATH, 1).alias("path")
    )
    kind = pages.schema["page_id"].dataType.simpleString()
    return parts.mapInArrow(
        work, f"page_id {kind}, host string, path string, rule string, verdict string"
    )


def op8_judge_urls(spark, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return judge_urls(read_table(spark, sf_dir, "pages").select("page_id", "url"))


OP8_SQL = r"""
WITH rules(rhost, rpath, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), cut AS (
  SELECT page_id, row_number() OVER () AS rid,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id, rid,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), ranked AS (
  SELECT p.*, rhost || rpath AS rule, r.verdict,
         row_number() OVER (PARTITION BY rid ORDER BY length(rhost || rpath) DESC NULLS LAST, length(rhost) DESC) AS place
  FROM parts p LEFT JOIN rules r
    ON (p.host = rhost OR ends_with(p.host, '.' || rhost)) AND starts_with(p.path, rpath)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM ranked WHERE place = 1
"""
