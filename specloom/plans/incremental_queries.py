"""Queries of manifest handling and stale-work selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from specloom.functions import text as X
from specloom.operators import diff, settings
from specloom.operators import incremental as inc
from specloom.plans.registry import query
from specloom.plans.views import ctes, view

# Options in long form: key, value, and for which jobs the key is present.
OWN_OPTIONS = [
    ("area", "concat('[', c_custkey % 50, ',10,500,600]')", "c_custkey % 2 = 0"),
    ("page", "concat(1 + c_custkey % 4)", "c_custkey % 3 = 0"),
    ("fix", "CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE '{\"cols\": []}' END", "c_custkey % 5 = 0"),
]
BASE_OPTIONS = [
    ("page", "concat(n_nationkey % 3)", "true"),
    ("sections", "CASE WHEN n_nationkey % 2 = 0 THEN 'empty-line' ELSE 'first-col' END", "true"),
    ("source", "'datasheet.pdf'", "true"),
    ("fix", "'{\"joiner\": []}'", "n_nationkey % 4 <> 1"),
]
_INHERIT = "CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 17 = 3 THEN 'ghost' ELSE 'main' END"


def _options(spec):
    entries = [F.when(F.expr(cond), F.struct(F.lit(k).alias("key"), F.expr(v).alias("value"))) for k, v, cond in spec]
    return F.map_from_entries(F.array_compact(F.array(*entries)))


def _options_sql(spec, source: str, keys: str) -> str:
    return " UNION ALL ".join(f"SELECT {keys}, '{k}' AS key, {v} AS value FROM {source} WHERE {cond}" for k, v, cond in spec)


def manifest(spark, sf):
    jobs = view(spark, sf, "customer")
    return jobs.select(
        F.concat(F.lit("stem"), "c_nationkey").alias("stem"),
        F.concat(F.lit("grp"), "c_custkey").alias("grp"),
        F.lit("extract").alias("stage"),
        F.expr(_INHERIT).alias("inherit"),
        F.array(_options(OWN_OPTIONS), F.map_from_arrays(F.array(F.lit("page")), F.array(F.lit("9")))).alias("infos"),
    )


def defaults(spark, sf):
    return view(spark, sf, "nation").select(
        F.concat(F.lit("stem"), "n_nationkey").alias("stem"), F.lit("extract").alias("stage"), F.lit("main").alias("name"), _options(BASE_OPTIONS).alias("opts")
    )


_MERGED = f"""WITH own AS ({_options_sql(OWN_OPTIONS, 'customer', 'c_custkey, 0 AS seq')} UNION ALL SELECT c_custkey, 1, 'page', '9' FROM customer),
base AS ({_options_sql(BASE_OPTIONS, 'nation', 'n_nationkey')}),
job AS (SELECT c_custkey, c_nationkey, s.seq, {_INHERIT} AS inherit FROM customer, (VALUES (0), (1)) AS s(seq)),
merged AS (SELECT j.c_custkey, j.seq, o.key, o.value FROM job j JOIN own o ON o.c_custkey = j.c_custkey AND o.seq = j.seq
  UNION ALL SELECT j.c_custkey, j.seq, b.key, b.value FROM job j JOIN base b ON b.n_nationkey = j.c_nationkey
  WHERE j.inherit = 'main' AND NOT EXISTS (SELECT 1 FROM own o WHERE o.c_custkey = j.c_custkey AND o.seq = j.seq AND o.key = b.key))"""


@query("inherit_defaults", _MERGED + " SELECT concat('grp', c_custkey) AS grp, CAST(seq AS INT) AS seq, key, value FROM merged")
def inherit_defaults(spark, sf):
    merged = inc.inherit_defaults(inc.stage_list(manifest(spark, sf)), defaults(spark, sf))
    return merged.select("grp", "seq", F.explode("opts"))


@query(
    "quarantine_manifest",
    f"SELECT concat('grp', c_custkey) AS grp, CAST(s.seq AS INT) AS seq, 'no default named ghost' AS reason FROM (SELECT *, {_INHERIT} AS inherit FROM customer), (VALUES (0), (1)) AS s(seq) WHERE inherit = 'ghost'",
)
def quarantine_manifest(spark, sf):
    merged = inc.inherit_defaults(inc.stage_list(manifest(spark, sf)), defaults(spark, sf))
    _, bad = inc.split_bad(merged, F.col("reason"))
    return bad.select("grp", "seq", "reason")


@query(
    "quarantine_settings",
    _MERGED + """, opt AS (SELECT j.c_custkey, j.seq, max(value) FILTER (key = 'source') AS source, max(value) FILTER (key = 'area') AS area, max(value) FILTER (key = 'page') AS page
  FROM job j LEFT JOIN merged m ON m.c_custkey = j.c_custkey AND m.seq = j.seq GROUP BY ALL)
SELECT concat('grp', c_custkey) AS grp, CAST(seq AS INT) AS seq, CASE WHEN source IS NULL THEN 'no source' WHEN area IS NULL THEN 'no area' ELSE 'page is no number from 1' END AS reason
FROM opt WHERE source IS NULL OR area IS NULL OR CAST(coalesce(page, '1') AS INT) < 1""",
)
def quarantine_settings(spark, sf):
    """Jobs whose merged options do not say where to read."""
    merged = inc.inherit_defaults(inc.stage_list(manifest(spark, sf)), defaults(spark, sf))
    return settings.settings_tables(merged, ["grp", "seq"]).rejects


_FILTER = "stem IN ('stem3', 'stem7') OR (segment = 'BUILDING' AND balance > 5000)"


@query("manifest_filter", f"SELECT * FROM (SELECT concat('stem', c_nationkey) AS stem, concat('grp', c_custkey) AS grp, c_mktsegment AS segment, c_acctbal AS balance FROM customer) WHERE {_FILTER}")
def manifest_filter(spark, sf):
    jobs = view(spark, sf, "customer").select(
        F.concat(F.lit("stem"), "c_nationkey").alias("stem"), F.concat(F.lit("grp"), "c_custkey").alias("grp"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance")
    )
    return inc.manifest_filter(jobs, _FILTER)


_TEMPLATE = "CASE WHEN p_partkey % 3 = 0 THEN '{series}' WHEN p_partkey % 3 = 1 THEN 'SUN {kw}kW - {series}' ELSE '{brand}/{series} plain' END"
_SERIES = "concat(p_type, '/', p_size)"
_GROUP_TEXT = f"replace(replace(replace({_TEMPLATE}, '{{series}}', {_SERIES}), '{{kw}}', concat(p_size % 7)), '{{brand}}', p_brand)"


@query(
    "group_template",
    f"SELECT p_partkey, {_GROUP_TEXT} AS grp, concat('solar/', p_brand, '/', replace({_GROUP_TEXT}, '/', '_'), '/extract/datasheet.csv') AS out_path FROM part",
)
def group_template(spark, sf):
    props = F.create_map(F.lit("series"), F.expr(_SERIES), F.lit("kw"), F.expr("concat(p_size % 7)"), F.lit("brand"), F.col("p_brand"))
    parts = view(spark, sf, "part").select("p_partkey", "p_brand", X.fill_template(F.expr(_TEMPLATE), props).alias("grp"))
    stem = F.concat(F.lit("solar/"), F.col("p_brand"))
    path = X.output_path(stem, F.col("grp"), F.lit("extract"), F.lit("datasheet"), F.lit("csv"))
    return parts.select("p_partkey", "grp", path.alias("out_path"))


_ITEM = "CASE c_custkey % 6 WHEN 0 THEN 'datasheet' WHEN 1 THEN 'manual.pdf' WHEN 2 THEN 'photo.jpeg' WHEN 3 THEN 'notes.txt' WHEN 4 THEN 'v1.2' ELSE 'page' END"
_URL = "concat('https://files.example.org/a.b/', c_custkey, CASE c_custkey % 4 WHEN 0 THEN '/sheet.pdf' WHEN 1 THEN '/view.php' WHEN 2 THEN '/index.html' ELSE '/raw' END)"
_TRUSTED = "('pdf', 'html', 'htm', 'png', 'jpg', 'jpeg')"
_SUFFIX = "regexp_extract({0}, '[^/.][^/]*[.]([^./]+)$', 1)"
_ITEMS = f"""WITH item AS (SELECT c_custkey, {_ITEM} AS item, {_URL} AS url FROM customer),
ext AS (SELECT *, {_SUFFIX.format('item')} AS own, {_SUFFIX.format('url')} AS remote FROM item),
picked AS (SELECT *, CASE WHEN own IN {_TRUSTED} THEN own WHEN remote IN {_TRUSTED} THEN remote END AS file_ext,
  CASE WHEN own IN {_TRUSTED} THEN regexp_replace(item, '[.][^./]+$', '') ELSE item END AS filename FROM ext)"""


def _items(spark, sf):
    items = view(spark, sf, "customer").select("c_custkey", F.expr(_ITEM).alias("item"), F.expr(_URL).alias("url"))
    return items.withColumns({"file_ext": X.trusted_extension(F.col("item"), F.col("url")), "filename": X.item_stem(F.col("item"))})


@query("trusted_ext", _ITEMS + " SELECT c_custkey, filename, file_ext FROM picked WHERE file_ext IS NOT NULL")
def trusted_ext(spark, sf):
    good, _ = inc.split_bad(_items(spark, sf), F.when(F.col("file_ext").isNull(), "no trusted extension"))
    return good.select("c_custkey", "filename", "file_ext")


@query("untrusted_items", _ITEMS + " SELECT c_custkey, item, url, 'no trusted extension' AS reason FROM picked WHERE file_ext IS NULL")
def untrusted_items(spark, sf):
    _, bad = inc.split_bad(_items(spark, sf), F.when(F.col("file_ext").isNull(), "no trusted extension"))
    return bad.select("c_custkey", "item", "url", "reason")


ART = ctes("v_artefact", "v_job")


@query("stage_times", ART + " SELECT stem, grp, stage, max(mtime) AS newest, min(mtime) AS oldest FROM v_artefact GROUP BY ALL")
def stage_times(spark, sf):
    return inc.stage_times(view(spark, sf, "v_artefact"))


_NOW = "TIMESTAMP '2001-03-01 00:00:00'"


@query(
    "stale_by_age",
    ART + f" SELECT j.stem, j.grp, j.filename, a.mtime FROM v_job j LEFT JOIN v_artefact a ON a.stem = j.stem AND a.grp = j.grp AND a.filename = j.filename AND a.stage = 'download'"
    f" WHERE a.mtime IS NULL OR a.mtime < {_NOW} - INTERVAL 84 DAYS",
)
def stale_by_age(spark, sf):
    items = view(spark, sf, "v_job").select("stem", "grp", "filename")
    return inc.stale_by_age(items, view(spark, sf, "v_artefact"), F.expr(_NOW))


@query(
    "stale_by_source",
    ART + " SELECT s.stem, s.grp, s.filename, s.mtime AS source_time, t.mtime AS target_time FROM v_artefact s LEFT JOIN v_artefact t"
    " ON t.stem = s.stem AND t.grp = s.grp AND t.filename = s.filename AND t.stage = 'extract' WHERE s.stage = 'download' AND (t.mtime IS NULL OR t.mtime < s.mtime)",
)
def stale_by_source(spark, sf):
    return inc.stale_by_source(view(spark, sf, "v_artefact"), "download", "extract")


_STATE = ART + """, manifest AS (SELECT DISTINCT concat('stem', c_custkey % 97) AS stem, TIMESTAMP '1995-01-01 00:00:00' + to_days(CAST((c_custkey % 97) * 20 AS INT)) AS manifest_time FROM customer),
ins AS (SELECT stem, grp, max(mtime) AS newest_in FROM v_artefact WHERE stage = 'extract' GROUP BY ALL),
outs AS (SELECT stem, grp, min(mtime) AS oldest_out FROM v_artefact WHERE stage = 'map' GROUP BY ALL),
state AS (SELECT stem, grp, newest_in, oldest_out, manifest_time, CASE WHEN newest_in IS NULL THEN 'error'
  WHEN greatest(newest_in, manifest_time) < oldest_out THEN 'skip' ELSE 'run' END AS state
FROM (SELECT coalesce(i.stem, o.stem) AS stem, coalesce(i.grp, o.grp) AS grp, newest_in, oldest_out FROM ins i FULL JOIN outs o ON i.stem = o.stem AND i.grp = o.grp)
LEFT JOIN manifest USING (stem))"""


def _manifests(spark, sf):
    time = F.timestamp_add("DAY", ((F.col("c_custkey") % 97) * 20).cast("int"), F.expr("TIMESTAMP '1995-01-01 00:00:00'"))
    stem = F.concat(F.lit("stem"), (F.col("c_custkey") % 97).cast("string"))
    return view(spark, sf, "customer").select(stem.alias("stem"), time.alias("manifest_time")).distinct()


@query("stale_stage", _STATE + " SELECT * FROM state")
def stale_stage(spark, sf):
    return inc.stage_state(view(spark, sf, "v_artefact"), _manifests(spark, sf), "extract", "map")


@query("stale_stage_due", _STATE + " SELECT * FROM state WHERE state = 'run'")
def stale_stage_due(spark, sf):
    return inc.stale_stage(view(spark, sf, "v_artefact"), _manifests(spark, sf), "extract", "map")


@query(
    "unconfigured_artefacts",
    ART + ", a AS (SELECT DISTINCT stem, grp, filename FROM v_artefact WHERE stage = 'download'), j AS (SELECT DISTINCT stem, grp, filename FROM v_job)"
    " SELECT stem, grp, filename, 'no_config' AS side FROM a ANTI JOIN j USING (stem, grp, filename) UNION ALL SELECT stem, grp, filename, 'no_artefact' FROM j ANTI JOIN a USING (stem, grp, filename)",
)
def unconfigured_artefacts(spark, sf):
    artefacts = view(spark, sf, "v_artefact").filter("stage = 'download'")
    return diff.unconfigured(artefacts, view(spark, sf, "v_job"), ["stem", "grp", "filename"])
