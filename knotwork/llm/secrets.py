"""Secret scans over an incremental ledger of blobs, in DataFrame operations only.

Every version of every document is named by the SHA-256 of its text. The ledger remembers which
(blob, rule version) pairs were scanned and what was found; a scan reads only unseen pairs, each blob
once, and findings are joined back to every path that holds the blob.

Spark has no function for the places of matches. They follow from the matches and the text between
them: splitting by a pattern and extracting its matches give two arrays whose lengths add up. The
lengths of texts with matches are exploded and summed up by a window, so time and memory grow in
proportion to the matches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, fresh, let, new_path, quoted, texts_of, width


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    #: Matches stay if this group has so many characters at least.
    group: int
    least: int
    version: int = 1
    #: The same expression for Java, where it needs possessive repeats so as not to use up the stack; SQL doesn't know them.
    steady: str = ""

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The three base patterns.
ASSIGN = Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6)
# A match of "AKIA[A-Z0-9]+" or "[0-9a-f]+" takes the whole run of its characters, so asking for the
# least length within the pattern gives the same matches as dropping the short ones afterwards.
ACCESS = Rule("access", r"AKIA[A-Z0-9]{16,}", 0, 20)
HEX = Rule("hex", r"[0-9a-f]{24,}", 0, 24)
BASE = (ASSIGN, ACCESS, HEX)
#: A key goes up to its END line; with none after it, to the end of the base64 text: runs of 40 characters or more
#: and a last shorter one. Headers within it hold single dashes. Written so that SQL's expressions know it too.
_LINES = r"(?:[\s\\]*[A-Za-z0-9+/]{40,})"
KEY = (
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[^-]*(?:-{1,4}[^-]+){0,40}-----END [A-Z ]*PRIVATE KEY-----"
    r"|(?:\s*(?:Proc-Type|DEK-Info):\x20*[^\s]+){0,2}(?:" + _LINES + r"+(?:=+|[\s\\]+[A-Za-z0-9+/]*=+|\r?\n[A-Za-z0-9+/]+(?m:$))?)?)"
)
#: Formats that name themselves: signed web tokens, private keys, credentials in an address.
MORE = (
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
    Rule("key", KEY, 0, 1, 2, KEY.replace(_LINES + "+", _LINES + "++")),
    Rule("login", r"[a-z][a-z0-9+.-]{1,15}://[^\s/:@]+:[^\s/:@]{3,}@", 0, 1, 2),
)
RULES = BASE + MORE
#: What a text must hold for a rule's pattern to be tried at all: each pattern implies it.
HINTS = {"assign": r"(?i)passw|secret|token|api_?key", "access": "AKIA", "hex": r"[0-9a-f]{24}", "jwt": "eyJ", "key": "-----BEGIN ", "login": "://"}
SPAN = "struct<start:int,rank:int,kind:string,end:int>"


def steps(text: Column, rule: Rule) -> Column:
    """For each match of the rule in the text, leftmost first and not overlapping: (characters before it, its own, those that count); then (characters after the last, null, null)."""
    pattern = rule.steady or rule.pattern
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sized = F.transform(found, F.length) if rule.group == 0 else F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.group)), F.length)
    return F.arrays_zip(F.transform(F.split(text, pattern, -1), F.length).alias("gap"), F.transform(found, F.length).alias("size"), sized.alias("kept"))


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, rule, spans) of every blob with a finding. blobs: (blob, text, unseen), unseen the rule names yet to be tried.

    Spans are places in code points, in order; matches that are too short are left out.
    """
    tried = [F.struct(F.lit(i).alias("rank"), F.when(F.array_contains("unseen", r.name) & F.col("text").rlike(HINTS.get(r.kind, r.pattern)), steps(F.col("text"), r)).alias("steps")) for i, r in enumerate(rules)]
    found = blobs.select("blob", F.explode(F.array(*tried)).alias("x")).where(F.size("x.steps") > 1)
    flat = found.select("blob", "x.rank", F.posexplode("x.steps").alias("at", "step")).select("blob", "rank", "at", "step.*")
    so_far = Window.partitionBy("blob", "rank").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = flat.withColumn("end", F.sum(F.col("gap") + F.coalesce("size", F.lit(0))).over(so_far).cast("int"))
    by_rank = lambda values: F.array(*map(F.lit, values))[F.col("rank")]
    span = F.struct((F.col("end") - F.col("size")).alias("start"), "rank", by_rank([r.kind for r in rules]).alias("kind"), "end")
    whole = placed.where(F.col("kept") >= by_rank([r.least for r in rules])).groupBy("blob", "rank").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    return whole.select("blob", by_rank([r.name for r in rules]).alias("rule"), F.col("spans").cast(f"array<{SPAN}>").alias("spans"))


class Ledger:
    """Two tables in a folder: scanned (blob, rules) and findings (blob, rule, spans). Appended to, never rewritten."""

    SCANNED, FINDINGS = "blob binary, rules array<string>", f"blob binary, rule string, spans array<{SPAN}>"

    def __init__(self, spark: SparkSession, path: str | None = None) -> None:
        self.spark, self.path = spark, path or new_path(spark, "ledger")

    def _table(self, name: str, schema: str) -> DataFrame:
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        if place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        return self.spark.createDataFrame([], schema)

    @property
    def scanned(self) -> DataFrame:
        return self._table("scanned", self.SCANNED)

    @property
    def findings(self) -> DataFrame:
        return self._table("findings", self.FINDINGS)

    def update(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """Scan what is unseen of versions (blob, text); return all findings under these rules.

        Copies of a blob are merged before and after the shuffle. Findings are appended before the
        scanned pairs, so a run that is broken off between the two repeats work but loses nothing;
        readers drop the repeated rows.
        """
        names = F.array(*[F.lit(r.name) for r in rules])
        seen = self.scanned.groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("seen"))
        unseen = F.array_except(names, F.coalesce("seen", F.expr("cast(array() as array<string>)")))
        blobs = versions.dropDuplicates(["blob"]).join(seen, "blob", "left")
        blobs = blobs.select("blob", "text", unseen.alias("unseen")).where(F.size("unseen") > 0)
        scan(blobs, rules).write.mode("append").parquet(f"{self.path}/findings")
        fresh = versions.select("blob").distinct().join(seen, "blob", "left").select("blob", unseen.alias("rules")).where(F.size("rules") > 0)
        fresh.write.mode("append").parquet(f"{self.path}/scanned")
        return self.findings.where(F.col("rule").isin([r.name for r in rules])).dropDuplicates(["blob", "rule"])


def named(spans_: Column) -> Column:
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def found_in(docs: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, found) for every row of docs: found has its spans by start, then rule order, and is null if there are none.

    A null text counts as empty. A repeated row gives a repeated result. The blob held by most paths
    is dealt over several tasks: each path joins one of `deal` copies of the few blobs with findings.
    """
    texts = texts_of(docs).withColumn("blob", F.unhex(F.sha2("text", 256)))
    found = ledger.update(texts.select("blob", "text"), rules)
    whole = found.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("found"))
    deal = min(32, width(docs.sparkSession))
    copies = whole.withColumn("_deal", F.explode(F.sequence(F.lit(0), F.lit(deal - 1))))
    paths = texts.select("doc_id", "blob").withColumn("_deal", F.pmod(F.hash("doc_id"), F.lit(deal)))
    return paths.join(copies, ["blob", "_deal"], "left").select("doc_id", "found")


def report(found: DataFrame) -> DataFrame:
    base = F.filter(F.col("found"), lambda s: s["rank"] < len(BASE))
    count = lambda kind: F.when(F.col("found").isNull(), F.lit(0)).otherwise(F.size(F.filter(F.col("found"), lambda s: s["kind"] == kind))).cast("long")
    return found.select(
        "doc_id", *[count(r.kind).alias(f"n_{r.kind}") for r in BASE],
        F.sha2(F.coalesce(named(base), F.lit("")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce(named(F.col("found")), F.lit("")).alias("spans"),
    )


def cuts(found: DataFrame) -> DataFrame:
    """(blob, at, to, marked) from findings: the stretches of each blob outside all spans, in code points, each but the last with a mark behind it.

    The last one's end is null. Spans that overlap count as one, spans that touch as two.
    """
    flat = found.select("blob", F.explode("spans").alias("s")).select("blob", "s.*")
    order = Window.partitionBy("blob").orderBy("start", "rank", "end")
    before = F.coalesce(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    opened = flat.withColumn("at", before).where(F.col("start") >= F.col("at")).select("blob", "at", F.col("start").alias("to"), F.lit(True).alias("marked"))
    last = flat.groupBy("blob").agg(F.max("end").alias("at")).select("blob", "at", F.lit(None).cast("int").alias("to"), F.lit(False).alias("marked"))
    return opened.unionByName(last)


#: Code points of a chunk that stretches are taken from: a place in a string is found by walking from its start.
CHUNK = 16_384


def rejoined(text: Column, stretches: Column, mark: str) -> Column:
    """The stretches (at, to, marked) of the text, one after the other, with marks between them."""
    chunk_of = lambda c: F.floor(c / CHUNK).cast("int")
    chunks = F.transform(F.sequence(F.lit(0), chunk_of(F.greatest(F.length(text), F.lit(1)) - 1)), lambda i: F.substring(text, i * CHUNK + 1, F.lit(CHUNK)))

    def stretch(s: Column, parts: Column) -> Column:
        to = F.coalesce(s["to"], F.size(parts) * CHUNK)

        def piece(k: Column) -> Column:
            low = F.greatest(s["at"] - k * CHUNK, F.lit(0))
            return F.substring(F.get(parts, k), low + 1, F.least(to - k * CHUNK, F.lit(CHUNK)) - low)

        own = F.when(to > s["at"], F.array_join(F.transform(F.sequence(chunk_of(s["at"]), chunk_of(F.greatest(to - 1, s["at"]))), piece), "")).otherwise("")
        return F.concat(own, F.when(s["marked"], F.lit(mark)).otherwise(""))

    return let(chunks, lambda parts: F.array_join(F.transform(stretches, lambda s: stretch(s, parts)), ""))


def redact(docs: DataFrame, ledger: Ledger | None = None, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """docs with every span of their text replaced by the mark, overlapping spans by one; nothing else changes.

    Works on the text itself, so equal texts are changed alike and rows need no id. Null and empty
    texts stay as they are, and so do repeated rows; an empty table gives an empty one.
    """
    ledger = ledger or Ledger(docs.sparkSession)
    name, left = fresh(docs, "blob", "left")
    text = F.coalesce(F.col("text"), F.lit(""))
    blob = F.unhex(F.sha2(text, 256))
    found = ledger.update(docs.select(blob.alias("blob"), text.alias("text")), rules)
    stretches = cuts(found).groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("at", "to", "marked"))).alias("left")).toDF(name, left)
    marked = docs.withColumn(name, blob).join(stretches, name, "left")
    clean = F.when(F.col(left).isNull(), F.col("text")).otherwise(rejoined(F.col("text"), F.col(left), mark))
    return marked.select(*[(clean if c == "text" else F.col(quoted(c))).alias(c) for c in docs.columns])


def op2_secret_scans(spark, sf_dir: str, ledger: str | None = None) -> DataFrame:
    """Findings of every row of documents. ledger: the folder of a ledger to go on with; else a new one is begun."""
    return report(found_in(documents(spark, sf_dir), Ledger(spark, ledger)))

