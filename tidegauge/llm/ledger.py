"""Secret scans with an incremental ledger of content-addressed blobs.

Every historical version of a file is a blob, named by the SHA-256 of its bytes. The
ledger is one Parquet table: a row per blob and scan, with the rule versions that were
applied and the spans they found (possibly none). A scan

1. hashes all versions and leaves out the pairs of blob and rule version that the ledger has,
2. takes one text of each blob that is left, and applies the missing rules,
3. appends to the ledger in one write, so that a lost job leaves either all rows or none,
4. joins the findings back to all paths that hold, or once held, the blob.

A rule whose version is raised is run again over all blobs; all others are not.

Defined cases: null content is the empty text; null paths are kept; repeated rows give
repeated results, but are scanned once; spans that start together are ordered by their rule;
very long texts are scanned whole; a scan that two writers did counts once; an empty table gives no rows; columns other than
the two named ones are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tidegauge.llm.batches import arrow_map
from tidegauge.llm.decontam import SMALL, small
from tidegauge.session import scratch, stored

SPAN = "struct<kind:string,start:int,end:int>"
LEDGER = f"blob binary, rules array<string>, spans array<{SPAN}>"


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds leftmost, non-overlapping matches; ``least`` is the length that
    group ``group`` must have. Shorter matches are dropped, but have used up their text.
    A text without any of the lower-case ``needles`` (if there are some) can have no match.
    """

    kind: str
    version: int
    pattern: re.Pattern
    least: int = 1
    group: int = 0
    needles: tuple[bytes, ...] = ()

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"

    def spans(self, text: str, low: bytes) -> list[tuple[int, int]]:
        if self.needles and not any(x in low for x in self.needles):
            return []
        return [m.span() for m in self.pattern.finditer(text) if m.end(self.group) - m.start(self.group) >= self.least]


# The patterns of the three base kinds, in their order.
_ASSIGN = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
BASE_RULES = (
    Rule("assign", 1, re.compile(_ASSIGN, re.IGNORECASE | re.ASCII), 6, 2, (b"passw", b"secret", b"token", b"api")),
    Rule("access", 1, re.compile(r"AKIA[A-Z0-9]+"), 20, 0, (b"akia",)),
    Rule("hex", 1, re.compile(r"[0-9a-f]{24,}"), 24),  # equal to the kept ones of [0-9a-f]+: a match is a whole run
)
# A key goes from its BEGIN to its END marker, whatever stands between them. Where the END is missing, it goes to the end
# of the base64: runs of 16 or more such characters, and shorter ones that fill a line (line ends may be escaped).
_BEGIN, _END = r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", r"-----END [A-Z ]{0,20}PRIVATE KEY-----"
_CLOSED = rf"[^-]*+(?:-(?!----(?:BEGIN|END)\x20)[^-]*+)*+{_END}"
_GAP, _LINE_END, _B64 = r"""(?:[\s>#"'|,]|\\[nrt])""", r"[\x20\t]*+(?:\r?\n|(?:\\r)?\\n)", r"[A-Za-z0-9+/=]"
_OPEN = rf"(?:{_LINE_END}(?:Proc-Type|DEK-Info):[^\r\n\\]*+)*+(?:{_GAP}++{_B64}{{16,}}+|{_LINE_END}[\x20\t]*+{_B64}++(?={_LINE_END}|\s*\Z|[\"']))*+"
#: Kinds of our own, which add to the base.
MORE_RULES = (
    Rule("github", 1, re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}"), needles=(b"ghp_", b"gho_", b"ghu_", b"ghs_", b"ghr_")),
    Rule("pem", 2, re.compile(rf"{_BEGIN}(?:{_CLOSED}|{_OPEN})"), needles=(b"private key-----",)),
    Rule("jwt", 1, re.compile(r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"), needles=(b"eyj",)),
)
RULES = BASE_RULES + MORE_RULES


def _scanner(rules: tuple[Rule, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    by_name = {r.name: r for r in rules}
    schema = pa.schema(
        [
            ("blob", pa.binary()),
            ("rules", pa.list_(pa.string())),
            ("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))),
        ]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            todo = batch.column("rules").to_pylist()
            for content, names in zip(batch.column("content"), todo, strict=True):
                text = content.as_py()
                low = text.encode().lower()
                spans.append([{"kind": by_name[n].kind, "start": a, "end": b} for n in names for a, b in by_name[n].spans(text, low)])
            yield pa.RecordBatch.from_arrays([batch.column("blob"), batch.column("rules"), pa.array(spans, schema.field("spans").type)], schema=schema)

    return scan


def read_ledger(spark, ledger: str) -> DataFrame:
    """The ledger at ``ledger``, empty where there is none yet."""
    try:
        return spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def scan_new(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> None:
    """Scan what the ledger lacks, each blob once. ``versions``: path, blob, content (not null).

    Copies of a blob meet on the map side, so one of each travels on, however many there are.
    """
    spark = versions.sparkSession
    done = read_ledger(spark, ledger).groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("done"))
    wanted = F.array(*[F.lit(r.name) for r in rules])
    todo = (
        versions.select("blob")
        .distinct()
        .join(done, "blob", "left")
        .select("blob", F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>"))).alias("rules"))
        .where(F.size("rules") > 0)
    )
    todo = stored(todo, "unseen")
    few = todo.limit(SMALL + 1).count() <= SMALL
    unseen = versions.join(F.broadcast(todo.select("blob")), "blob", "left_semi") if few else versions
    once = unseen.groupBy("blob").agg(F.any_value("content").alias("content")).join(todo, "blob")
    arrow_map(once.select("blob", "rules", "content"), _scanner(rules), LEDGER).write.mode("append").parquet(ledger)


def _versions(history: DataFrame, path: str, content: str) -> DataFrame:
    text = F.coalesce(F.col(content), F.lit(""))
    return history.select(F.col(path).alias("path"), blob_of(F.col(content)).alias("blob"), text.alias("content"))


def blob_of(content: Column) -> Column:
    """The address of a content: the SHA-256 of its bytes."""
    return F.unhex(F.sha2(F.coalesce(content, F.lit("")), 256))


def findings(spark, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``blob`` and ``spans`` of the blobs in which ``rules``, in these versions, found something.

    Spans hold kind, start and end (code points, end exclusive), by start, then in the order of ``rules``.
    """
    kinds = {r.kind: i for i, r in enumerate(rules)}
    names = F.array(*[F.lit(r.name) for r in rules])
    order = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
    # A row's spans are those of its rule versions; only wanted versions count.
    wanted = F.transform(F.array_intersect("rules", names), lambda name: F.substring_index(name, "@", 1))
    own = F.filter("spans", lambda s: F.array_contains(wanted, s["kind"]))
    rows = read_ledger(spark, ledger).where(F.size("spans") > 0).select("blob", own.alias("spans")).groupBy("blob")
    rows = rows.agg(F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"))  # a scan that was done twice counts once
    sortable = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    ordered = F.transform(F.array_sort(sortable), lambda s: F.struct(s["kind"], s["start"], s["end"]))
    return rows.where(F.size("spans") > 0).select("blob", ordered.alias("spans"))


def scan_history(
    history: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, path: str = "path", content: str = "content"
) -> DataFrame:
    """``path``, ``blob`` (binary) and ``spans`` (see `findings`) of each row, after scanning what was new."""
    versions = _versions(history, path, content)
    scan_new(versions, ledger, rules)
    found = versions.select("path", "blob").join(findings(history.sparkSession, ledger, rules), "blob", "left")
    return found.select("path", "blob", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans"))


def redacted(history: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, path: str = "path", content: str = "content", mark: str = "[secret]") -> DataFrame:
    """``history`` with every span that was found in ``content`` replaced by ``mark``; spans that overlap make one."""
    scan_new(_versions(history, path, content), ledger, rules)
    found = small(findings(history.sparkSession, ledger, rules)).select(F.col("blob").alias("__blob"), F.col("spans").alias("__spans"))
    text = F.col(content)
    cut = F.aggregate(
        "__spans",
        F.struct(F.lit("").alias("text"), F.lit(0).alias("at")),
        lambda done, s: F.struct(
            F.concat(
                done["text"],
                F.when(s["start"] >= done["at"], F.concat(text.substr(done["at"] + 1, s["start"] - done["at"]), F.lit(mark))).otherwise(F.lit("")),
            ).alias("text"),
            F.greatest(done["at"], s["end"]).alias("at"),
        ),
        lambda done: F.concat(done["text"], text.substr(done["at"] + 1, F.length(text))),
    )
    joined = history.join(found, blob_of(text) == F.col("__blob"), "left")
    clean = F.when(F.col("__spans").isNull(), text).otherwise(cut)
    return joined.select(*[clean.alias(c) if c == content else F.col(c) for c in history.columns])


def _joined(spans, kinds=None):
    kept = spans if kinds is None else F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op6_blob_ledger(spark, sf_dir: str) -> DataFrame:
    """Secrets of all documents, each document being a path with one version, and a new ledger."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = scan_history(documents, scratch(spark, "ledger"), RULES, "doc_id", "text")
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = [r.kind for r in BASE_RULES]
    return found.select(
        F.col("path").alias("doc_id"),
        *[number(kind).alias(f"n_{kind}") for kind in base],
        F.sha2(_joined(F.col("spans"), base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )
