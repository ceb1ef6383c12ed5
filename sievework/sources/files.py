"""Readers and writers of the file shapes that posting data come in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.functions.payloads import PUBLIC_IDENTITIES, safe_json
from sievework.functions.postings import listed_activity
from sievework.functions.records import created_at
from sievework.operators.scopes import paired_scopes

_S = T.StringType()

#: Columns of a posting record, with their kinds; all text but for the lists.
RECORD = T.StructType([T.StructField(n, _S) for n in "job_id title salary salary_source location tags boss_name company_name boss_title boss_active_status experience education company_scale company_stage company_industry job_labels job_link company_link welfare jd job_type proxy_job proxy_type page_update_date".split()] + [T.StructField(n, T.ArrayType(_S)) for n in ("skills", "skill_tags")])

#: Columns of a raw list item, under the names that responses use.
RAW_ITEM = T.StructType([T.StructField(n, _S) for n in "encryptJobId jobName salaryDesc cityName areaDistrict businessDistrict brandName bossTitle jobExperience jobDegree brandScaleName brandStageName brandIndustry jobType proxyJob proxyType activeTimeDesc".split()] + [T.StructField(n, T.ArrayType(_S)) for n in ("jobLabels", "welfareList", "skills")] + [T.StructField("bossOnline", T.BooleanType())])


def _documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as path, modified and parsed value; null where a file isn't JSON."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("modified"), "value")
    return raw.withColumn("doc", F.try_parse_json("value"))


def read_exports(spark: SparkSession, path: str) -> DataFrame:
    """Records of export files, which hold an object with jobs or a bare array: path, ordinal and the record's columns. Other files give no rows."""
    array = T.ArrayType(RECORD)
    docs = _documents(spark, path)
    jobs = F.coalesce(F.try_variant_get("doc", "$.jobs", array.simpleString()), F.try_variant_get("doc", "$", array.simpleString()))
    return docs.select("path", F.posexplode(jobs).alias("ordinal", "r")).select("path", "ordinal", "r.*")


def split_files(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(records, bad files): export files' records, and the files that have none with the reason: empty (white space), not_json, no_records. Spark reads no file of zero bytes; ``inventory`` finds those."""
    array = T.ArrayType(RECORD).simpleString()
    docs = _documents(spark, path)
    jobs = F.coalesce(F.try_variant_get("doc", "$.jobs", array), F.try_variant_get("doc", "$", array))
    reason = F.when(~F.coalesce("value", F.lit("")).rlike("\\S"), "empty").when(F.col("doc").isNull(), "not_json").when(jobs.isNull(), "no_records")
    read = docs.select("path", "modified", jobs.alias("jobs"), reason.alias("reason"))
    rows = read.where("reason is null").select("path", F.posexplode("jobs").alias("ordinal", "r")).select("path", "ordinal", "r.*")
    return rows, read.where("reason is not null").select("path", "modified", "reason")


def append_log(df: DataFrame, path: str, reserved: dict[str, Column]) -> None:
    """Rows added to a JSON-lines log; reserved fields are set last, so that no free field replaces them."""
    df.withColumns(reserved).write.mode("append").json(path)


def read_details(spark: SparkSession, path: str) -> DataFrame:
    """Records of detail files, each a bare array; another shape is an error."""
    array = T.ArrayType(RECORD).simpleString()
    docs = _documents(spark, path)
    rows = F.coalesce(F.try_variant_get("doc", "$", array), F.raise_error(F.concat(F.lit("not an array of records: "), "path")).cast(array))
    return docs.select("path", F.posexplode(rows).alias("ordinal", "r")).select("path", "ordinal", "r.*")


def read_raw_lists(spark: SparkSession, path: str) -> DataFrame:
    """Items of raw responses in any of their three shapes: one response, pages of responses, or a bare array."""
    item = RAW_ITEM.simpleString()
    docs = _documents(spark, path)
    one, bare = f"array<{item}>", f"array<{item}>"
    pages = f"array<struct<response:struct<zpData:struct<jobList:array<{item}>>>>>"
    paged = F.flatten(F.transform(F.try_variant_get("doc", "$.list_pages", pages), lambda p: F.coalesce(p.response.zpData.jobList, F.array().cast(one))))
    items = F.coalesce(F.try_variant_get("doc", "$.zpData.jobList", one), paged, F.try_variant_get("doc", "$", bare))
    return docs.select("path", F.posexplode(items).alias("ordinal", "r")).select("path", "ordinal", "r.*")


def item_to_record(items: DataFrame, seen: Column | None = None) -> DataFrame:
    """Raw items as records: renamed, blank where missing, places joined by ·, tags without "不限". seen: when the links were valid, as text."""
    text = lambda c: F.coalesce(F.trim(c), F.lit(""))
    joined = lambda by, *cs: F.array_join(F.filter(F.array(*map(text, cs)), lambda x: x != ""), by)
    tags = F.filter(F.array(text("jobExperience"), text("jobDegree")), lambda x: (x != "") & ~x.contains("不限"))
    link = F.when(text("encryptJobId") != "", F.concat(F.lit("/job/"), text("encryptJobId"))).otherwise(F.lit(""))
    return items.select(
        F.substring(F.md5(F.when(link != "", link).otherwise(text("jobName"))), 1, 16).alias("job_id"), text("jobName").alias("title"), text("salaryDesc").alias("salary"),
        joined("·", "cityName", "areaDistrict", "businessDistrict").alias("location"), F.array_join(tags, " | ").alias("tags"), text("brandName").alias("company_name"), text("bossTitle").alias("boss_title"),
        listed_activity("activeTimeDesc", "bossOnline").alias("boss_active_status"), text("jobExperience").alias("experience"), text("jobDegree").alias("education"), text("brandScaleName").alias("company_scale"), text("brandStageName").alias("company_stage"),
        text("brandIndustry").alias("company_industry"), F.array_join(F.coalesce("jobLabels", F.array().cast("array<string>")), " | ").alias("job_labels"), F.array_join(F.coalesce("welfareList", F.array().cast("array<string>")), " | ").alias("welfare"),
        F.coalesce("skills", F.array().cast("array<string>")).alias("skills"), link.alias("job_link"), text("jobType").alias("job_type"), text("proxyJob").alias("proxy_job"), text("proxyType").alias("proxy_type"),
        (F.lit("") if seen is None else seen).alias("link_verified_at"),
    )


def read_log(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, bad lines) of a JSON-lines log."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    rows = lines.select("value", F.from_json("value", f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad"}).alias("r"))
    return rows.where("r._bad is null").select("r.*").drop("_bad"), rows.where("r._bad is not null").select(F.col("value").alias("line"))


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """path, name, kind, bytes, modified, stem: the files of a folder, from their metadata alone."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", "modificationTime")
    name = F.element_at(F.split("path", "/"), -1)
    kind = F.when(name.contains("deliverable"), "deliverable").when(name.contains("details"), "details").when(name.rlike("(?i)\\.csv$"), "csv").when(name.rlike("(?i)\\.jsonl$"), "log").when(name.rlike("(?i)\\.json$"), "list").otherwise("other")
    return f.select("path", name.alias("name"), kind.alias("kind"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"), F.regexp_replace("path", "\\.[A-Za-z]+$", "").alias("stem"))


def read_index(spark: SparkSession, path: str, stale_before: Column | None = None) -> DataFrame:
    """path, kind, city, keyword, scope_key, inferred, created_at, jobs, with_body, bytes, status, stale: what each JSON file of a folder is, from its name and its head.

    A scope comes from the file's stamp, its source or its meta data; without a key, city and keyword make one.
    created_at: the stamp, the time of the data, else the file's. Of a scope's deliverables all but the newest
    are superseded. Detail files take the scope of the list with the same stamp in their name.
    """
    docs = _documents(spark, path)
    get = lambda *paths: F.coalesce(*[F.when(F.trim(F.try_variant_get("doc", p, "string")) != "", F.trim(F.try_variant_get("doc", p, "string"))) for p in paths])
    jobs = F.try_variant_get("doc", "$.jobs", "array<struct<jd:string>>")
    rows = F.coalesce(jobs, F.try_variant_get("doc", "$", "array<struct<jd:string>>"))
    name, shape = F.element_at(F.split("path", "/"), -1), F.schema_of_variant("doc")
    stamped = get("$.artifact.kind")
    made = F.coalesce(get("$.source", "$.clean_of", "$.sources"), F.when(get("$.scope").isNotNull() & get("$.format_version").isNull(), "x")).isNotNull()
    kind = F.when(name.rlike("\\.(pending|failures)\\.json$"), "ledger").when(name.contains("details_") | shape.startswith("ARRAY"), "details").when(jobs.isNotNull(), F.coalesce(stamped, F.when(made, "deliverable"), F.lit("list"))).otherwise("ledger")
    city, keyword = get("$.artifact.scope.city", "$.source.city", "$.city"), get("$.artifact.scope.keyword", "$.source.keyword", "$.keyword")
    label = get("$.artifact.scope.label", "$.scope")
    stated = get("$.artifact.scope_key")
    key = F.coalesce(stated, F.concat(city, F.lit("|"), F.coalesce(keyword, F.substring(label, 1, 40))))
    found = docs.select("path", kind.alias("kind"), city.alias("city"), keyword.alias("keyword"), key.alias("scope"), (stated.isNull() & key.isNotNull()).alias("inferred"), created_at(get("$.artifact.created_at"), get("$.scraped_at"), F.col("modified")).alias("created_at"), F.coalesce(F.size(rows), F.lit(0)).alias("jobs"), F.coalesce(F.size(F.filter(rows, lambda r: F.trim(r.jd) != "")), F.lit(0)).alias("with_body"), F.octet_length("value").alias("bytes"))
    found = paired_scopes(found)
    newest = found.where("kind = 'deliverable' and scope is not null").groupBy(F.col("scope").alias("_s")).agg(F.max(F.struct("created_at", "path")).alias("_n"))
    out = found.join(newest, (F.col("kind") == "deliverable") & (F.col("scope") == F.col("_s")), "left")
    status = F.when(F.col("_n").isNull() | (F.struct("created_at", "path") == F.col("_n")), "active").otherwise("superseded")
    stale = F.lit(False) if stale_before is None else F.coalesce(F.col("created_at") < stale_before, F.lit(False))
    return out.withColumns({"status": status, "stale": stale}).drop("_s", "_n").withColumnRenamed("scope", "scope_key")


def write_safe(df: DataFrame, path: str, mode: str = "errorifexists", keep: tuple[str, ...] = ()) -> None:
    """JSON lines with sorted keys and without secrets, internal keys (but for ``keep``) and hidden parameters of URLs."""
    rows = df.select(F.to_json(F.struct("*")).alias("raw"))
    safe_json(rows, "raw", "value", keep).select("value").write.mode(mode).text(path)


def write_raw(df: DataFrame, payload: str, path: str, mode: str = "append") -> None:
    """Raw answers as JSON lines: secrets and personal values go, the identities that public links show stay. What is no JSON isn't kept."""
    safe_json(df, payload, "value", PUBLIC_IDENTITIES).where(F.col("value").isNotNull()).select("value").write.mode(mode).text(path)


def sidecars(files: DataFrame) -> DataFrame:
    """stem, files, bytes: files that differ in their suffix only."""
    return files.groupBy("stem").agg(F.array_sort(F.collect_list("name")).alias("files"), F.sum("bytes").alias("bytes"))


def write_records(df: DataFrame, path: str, kind: str = "parquet", by: list[str] = (), mode: str = "errorifexists") -> None:
    """Parquet, JSON or CSV; arrays become text joined by bars in CSV, and each file begins with a byte order mark, as spreadsheets ask for. Spark's committer makes the write all or nothing."""
    if kind == "csv":
        flat: list[Column] = [F.array_join(c.name, " | ").alias(c.name) if isinstance(c.dataType, T.ArrayType) else F.col(c.name) for c in df.schema]
        first, *others = df.columns
        df.select(*flat).toDF(f"\ufeff{first}", *others).write.mode(mode).option("header", True).option("escape", '"').csv(path)
    else:
        df.write.mode(mode).partitionBy(*by).format(kind).save(path)


def with_schema_of(old: DataFrame, new: T.StructType) -> DataFrame:
    """An older table under a newer schema: missing columns are null, none is lost."""
    empty = old.sparkSession.createDataFrame([], new)
    return empty.unionByName(old, allowMissingColumns=True)
