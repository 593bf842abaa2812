"""Operator 6: secret scans with an incremental blob ledger.

Every version of a text is addressed by its content (SHA-256). The
ledger holds one row per blob and rule version that was ever scanned,
with the spans found. A scan reads only (blob, rule version) pairs that
the ledger lacks, and joins findings back to every path that carries
the blob. Only DataFrame functions: positions come from the lengths of
the stretches between matches and of the matches, in code points.

Base rules, leftmost non-overlapping per kind; matches that fail the
length test are dropped after matching. A null text counts as empty.
Paths may repeat or be null: every row of ``versions`` gets its own row
back. Columns other than those named are ignored; empty tables give
empty results. The spans of one text are gathered in one array; a text of
any length is searched whole in one task. ``scan_round`` keeps the ledger
as a Parquet table from scan to scan; the registered query starts with an
empty one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.llm.common import saved
from emporia.sources.sinks import exists


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds a secret; its group ``group`` must have ``least`` code points. ``version`` marks changes."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"


_KEY = "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
# For the last two the length bound is in the pattern: a shorter run of these characters holds no other match.
RULES = (
    Rule("assign", rf"""({_KEY})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, least=8),
    Rule("access", "AKIA[A-Z0-9]{12,}", least=16),
    Rule("hex", "[0-9a-f]{32,}", least=32),
)
LEDGER = "blob string, rule string, spans array<struct<start:int,end:int>>"


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _spans(between: Column, match: Column, value: Column, least: int) -> Column:
    """Start and end of every match whose value is long enough; ``between`` has one item more than ``match``."""
    none = F.array().cast("array<struct<start:int,end:int>>")
    start = F.struct(F.lit(0).alias("pos"), none.alias("found"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["pos"] + F.length(x["b"])
        end = begin + F.length(x["m"])
        hit = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(end.alias("pos"),
                        F.when(F.length(x["v"]) >= least, F.concat(acc["found"], hit)).otherwise(acc["found"])
                        .alias("found"))

    return F.aggregate(F.arrays_zip(F.slice(between, F.lit(1), F.size(match)).alias("b"), match.alias("m"),
                                    value.alias("v")), start, step, lambda acc: acc["found"])


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows of ``blobs`` (blob, text, seen: rules already done) for the rules not seen."""
    found = blobs.select("blob", "text", "seen", *(
        F.when(F.array_contains("seen", r.id), None)
        .otherwise(F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0))).alias(f"m{i}")
        for i, r in enumerate(rules)))
    # Most texts hold no match of a rule: the second pass over the text is for the others only.
    apart = found.select("blob", *(f"m{i}" for i in range(len(rules))), *(
        F.when(F.size(f"m{i}") > 0, F.split("text", r.pattern, -1)).alias(f"b{i}") for i, r in enumerate(rules)), *(
        F.when(F.size(f"m{i}") > 0, F.regexp_extract_all("text", F.lit(r.pattern), F.lit(r.group))).alias(f"v{i}")
        for i, r in enumerate(rules)))
    empty = F.array().cast("array<struct<start:int,end:int>>")
    entry = F.array(*(
        F.struct(F.lit(r.id).alias("rule"),
                 F.when(F.col(f"m{i}").isNull(), None)
                 .when(F.size(f"m{i}") == 0, empty)
                 .otherwise(_spans(F.col(f"b{i}"), F.col(f"m{i}"), F.col(f"v{i}"), r.least)).alias("spans"))
        for i, r in enumerate(rules)))
    return (apart.select("blob", F.explode(entry).alias("e"))
            .filter("e.spans is not null").select("blob", "e.rule", "e.spans"))


def update_ledger(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES,
                  text: str = "text") -> DataFrame:
    """The ledger rows to add for ``versions``: one per unseen (blob, rule version)."""
    # any_value is combined before the shuffle: a text with many copies is sent once per task.
    blobs = (versions.select(blob_id(F.col(text)).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
             .groupBy("blob").agg(F.any_value("text").alias("text")))
    wanted = [r.id for r in rules]
    none = F.array().cast("array<string>")
    if ledger is None:
        todo = blobs.withColumn("seen", none)
    else:
        done = ledger.filter(F.col("rule").isin(wanted)).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        todo = (blobs.join(done, "blob", "left").withColumn("seen", F.coalesce("seen", none))
                .filter(F.size("seen") < len(wanted)))
    return scan_blobs(todo, rules)


def findings(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text",
             keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Every row of ``versions``: its ``keep`` columns, ``blob`` and ``found``: array of (start, kind_no, end, kind)."""
    number = F.create_map(*(x for i, r in enumerate(rules) for x in (F.lit(r.id), F.lit(i))))
    kind = F.create_map(*(x for r in rules for x in (F.lit(r.id), F.lit(r.kind))))
    per_blob = (ledger.filter(F.col("rule").isin([r.id for r in rules])).dropDuplicates(["blob", "rule"])
                .filter(F.size("spans") > 0)
                .select("blob", F.transform("spans", lambda s: F.struct(
                    s["start"].alias("start"), number[F.col("rule")].alias("kind_no"), s["end"].alias("end"),
                    kind[F.col("rule")].alias("kind"))).alias("part"))
                .groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("part"))).alias("found")))
    # A stored table: the join below then deals out both sides itself and can split a blob with many paths.
    per_blob = saved(per_blob)
    none = F.array().cast("array<struct<start:int,kind_no:int,end:int,kind:string>>")
    return (versions.select(*keep, blob_id(F.col(text)).alias("blob")).join(per_blob, "blob", "left")
            .withColumn("found", F.coalesce("found", none)))


def scan(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, text: str = "text",
         keep: tuple[str, ...] = ("doc_id",)) -> tuple[DataFrame, DataFrame]:
    """(findings of every row, the ledger with what this scan added)."""
    new = update_ledger(versions, ledger, rules, text)
    full = new if ledger is None else ledger.select("blob", "rule", "spans").unionByName(new)
    return findings(versions, full, rules, text, keep), full


def read_ledger(spark: SparkSession, path: str, but_round: str | None = None) -> DataFrame:
    """The stored ledger (empty where there is none yet), without the rows of one round if named."""
    if not exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    rows = spark.read.schema(f"{LEDGER}, round string").parquet(path)
    return (rows if but_round is None else rows.filter(F.col("round") != but_round)).drop("round")


def scan_round(versions: DataFrame, path: str, round_id: str, rules: tuple[Rule, ...] = RULES, text: str = "text",
               keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Findings of ``versions`` against the ledger stored at ``path``, which gains what this round scanned.

    A round's rows are one partition of the ledger: a round that is run
    again, after a lost job or with more versions, replaces its own.
    """
    spark = versions.sparkSession
    before = read_ledger(spark, path, round_id)
    new = update_ledger(versions, before, rules, text)
    new.select("blob", "rule", "spans").write.mode("overwrite").parquet(f"{path.rstrip('/')}/round={round_id}")
    return findings(versions, read_ledger(spark, path), rules, text, keep)


def listed(found: Column) -> Column:
    """kind:start:end of all spans by start, then kind, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, n_<kind> per rule, base_sha256 and spans of ``findings``."""
    def of(*kinds: str) -> Column:
        return F.filter("found", lambda s: s["kind"].isin(*kinds))

    base = of(*(r.kind for r in RULES))
    return found.select("doc_id", *(F.size(of(r.kind)).cast("long").alias(f"n_{r.kind}") for r in rules),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret found replaced by ``mark`` and ``n_chars`` brought up to date; all columns stay.

    The same rules as in ``scan``, applied to the texts of rows whose
    blob has findings; rows without findings pass unchanged.
    """
    cols = docs.columns
    # The row as one column: no name can clash.
    found, _ = scan(docs.select(F.struct(*cols).alias("_row"), "text"), keep=("_row",))
    text = F.col("_row")["text"]
    # Overlapping spans of different kinds are merged, then the text is rebuilt from the stretches outside of them.
    merged = F.aggregate(
        "found", F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["pos"], s["end"]).alias("pos"),
            F.when(s["start"] >= acc["pos"],
                   F.concat(acc["out"], F.array(F.substring(text, acc["pos"] + 1, s["start"] - acc["pos"]),
                                                F.lit(mark)))).otherwise(acc["out"]).alias("out")),
        lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["pos"] + 1, F.length(text))))
    hit = F.size("found") > 0
    out = found.select("_row", hit.alias("_hit"), merged.alias("_clean"))
    own = {"text": F.col("_clean"), "n_chars": F.length("_clean").cast("long")}
    return out.select(*(F.when(F.col("_hit"), own[c]).otherwise(F.col("_row")[c]).alias(c) if c in own
                        else F.col("_row")[c].alias(c) for c in cols))
