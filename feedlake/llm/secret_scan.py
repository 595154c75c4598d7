r"""Secret scans with an incremental ledger of blobs.

Every version of every document is content-addressed: the SHA-256 of its text names a blob.
The ledger holds, for each pair of blob and rule version scanned so far, the spans found.  A
scan addresses all rows, keeps the pairs the ledger has not seen, sends one text per unseen
blob to the scanner, appends the findings, and joins the ledger back to all paths (rows) that
hold the blob.  A second scan of the same versions scans no text a second time.  A blob is picked at its
smallest path; where rows of one path and text occur again, one of them is taken before the
scanner.  Texts meet the list of unseen blobs where they lie if it is of checked size (``beside``).

The ledger is a folder of Parquet files, ``rule_version=<v>/``; a batch is appended by Spark's
committer, so a lost executor or a failed job leaves no half batch.  Should two scans append
one blob, the findings are the same and count once.

Rows.  A null text counts as empty; so does an empty one, and both have no spans.  Texts are
scanned whole.  Repeated rows share one blob and each get its findings.  Null paths are kept.
An empty table scans nothing.  Only the path and text columns are read.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import beside, remove, ship, store

# The kinds of secrets, in the order in which they are listed at one start.
BASE_KINDS = ("assign", "access", "hex")
ADDED_KINDS = ("pem", "jwt", "forge", "chat")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
PEM = re.compile(r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END (?:[A-Z]+ )?PRIVATE KEY-----")
JWT = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")
FORGE = re.compile(r"(?:gh[pousr]_[A-Za-z0-9]{36,}|glpat-[A-Za-z0-9_-]{20,})")
CHAT = re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,}")
#: A change of any pattern needs a new version, so that all blobs are scanned again.
RULE_VERSION = 1

SPANS = "array<struct<kind:string,start:int,end:int>>"
LEDGER = f"blob string, spans {SPANS}"
#: Lower-cased words of which one stands in every match of ``ASSIGN``.
_HINTS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_HEX_MAP = bytes(0x68 if b in b"0123456789abcdef" else 0x20 for b in range(256))


def find_spans(text: str | None) -> list[tuple[str, int, int]]:
    """Spans of all kinds by start, then by kind as listed; ends are exclusive, in code points.

    The plain searches before the patterns only spare texts in which the pattern cannot match.
    """
    if not text:
        return []
    raw, found = text.encode(), []
    lower = raw.lower()
    if any(h in lower for h in _HINTS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if b"AKIA" in raw:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    if b"h" * 32 in raw.translate(_HEX_MAP):
        found += [("hex", *m.span()) for m in HEX.finditer(text)]
    if b"PRIVATE KEY" in raw:
        found += [("pem", *m.span()) for m in PEM.finditer(text)]
    if b"eyJ" in raw:
        found += [("jwt", *m.span()) for m in JWT.finditer(text)]
    if b"gh" in raw or b"glpat-" in raw:
        found += [("forge", *m.span()) for m in FORGE.finditer(text)]
    if b"xox" in raw:
        found += [("chat", *m.span()) for m in CHAT.finditer(text)]
    order = {k: i for i, k in enumerate(BASE_KINDS + ADDED_KINDS)}
    return sorted(found, key=lambda s: (s[1], order[s[0]], s[2]))


def _scan(texts: pd.Series) -> pd.Series:
    names = "kind", "start", "end"
    return pd.Series([[dict(zip(names, span, strict=True)) for span in find_spans(t)] for t in texts], dtype=object)


def read_ledger(spark, path: str, rule_version: int) -> DataFrame:
    """Findings of one rule version; empty if nothing has been scanned under it yet."""
    folder = f"{path}/rule_version={rule_version}"
    try:
        return spark.read.schema(LEDGER).parquet(folder).dropDuplicates(["blob"])
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def address(versions: DataFrame, path_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``path`` and ``blob`` of every row."""
    return versions.select(
        F.col(path_col).alias("path"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("blob")
    )


def update_ledger(
    versions: DataFrame, ledger: str, path_col: str = "doc_id", text_col: str = "text", rule_version: int = RULE_VERSION
) -> None:
    """Scan the blobs that the ledger lacks under this rule version and append their findings."""
    spark = versions.sparkSession
    ship(spark)
    known = read_ledger(spark, ledger, rule_version).select("blob")
    places = address(versions, path_col, text_col).groupBy("blob", "path").agg(F.count(F.lit(1)).alias("copies"))
    first = places.groupBy("blob").agg(F.min(F.struct("path", "copies")).alias("at")).select("blob", "at.path", "at.copies")
    unseen = store(first.join(known, "blob", "left_anti"), "unseen")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = versions.select(F.col(path_col).alias("at"), text.alias("text"), F.sha2(text, 256).alias("digest"))
    here = F.col("at").eqNullSafe(F.col("path")) & (F.col("digest") == F.col("blob"))
    texts = rows.join(beside(unseen.filter("copies = 1")), here).select("blob", "text")
    again = unseen.filter("copies > 1")
    if not again.isEmpty():
        texts = texts.unionByName(rows.join(beside(again), here).select("blob", "text").dropDuplicates(["blob"]))
    findings = texts.select("blob", F.pandas_udf(_scan, SPANS)("text").alias("spans"))
    findings.write.mode("append").parquet(f"{ledger}/rule_version={rule_version}")
    remove(unseen)


def scan_versions(
    versions: DataFrame, ledger: str, path_col: str = "doc_id", text_col: str = "text", rule_version: int = RULE_VERSION
) -> DataFrame:
    """``path``, ``blob`` and ``spans`` of every row, after bringing the ledger up to date."""
    update_ledger(versions, ledger, path_col, text_col, rule_version)
    rows = address(versions, path_col, text_col)
    # A blob that many paths share meets its one ledger row; both sides come from a shuffle, so AQE can split them.
    findings = read_ledger(versions.sparkSession, ledger, rule_version).filter(F.size("spans") > 0).hint("rebalance")
    return rows.join(findings, "blob", "left").withColumn("spans", F.coalesce("spans", F.array().cast(SPANS)))
