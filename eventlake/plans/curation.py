"""The composed curation plan: normalize, enrich, apply rules, validate and count, in one lazy plan."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo, times
from ..operators import normalize, rules, validate
from .normalize_queries import CENTER, _KM
from .registry import ev, query, read
from .rule_queries import Rule

RULES = [
    Rule(1, "delete", "organizer LIKE '%7' AND location_name = 'NATION_3'"), Rule(2, "tag", "lower(name) LIKE '%urgent%'", "URGENT"), Rule(3, "tag", "url LIKE '%src2.%'", "SRC2"),
    Rule(4, "type", "name LIKE 'BUILDING%'", "BusinessEvent"), Rule(5, "tag", "m_2 AND end_ts > start_ts", "URGENT-MULTIDAY", needs=(2,)), Rule(6, "tag", "NOT m_3 AND location_name LIKE '%_1_'", "TEENS", needs=(3,)),
]
CHECKS = validate.Checks(required=("name", "organizer"), allowed={"type": ("Event", "MusicEvent")}, patterns={"url": "^https://src"})


def curate(spark, d):
    """Event records, normalized, enriched and curated."""
    df = ev(spark, d).withColumn("end_ts", times.default_end(F.col("start_ts"), F.col("end_ts")))
    lat, lng = geo.valid_pair(F.col("lat"), F.col("lng"))
    df = df.withColumns({"lat": lat, "lng": lng})
    df = normalize.tag_outside_radius(df, "lat", "lng", CENTER, 50, "FAR")
    patches = read(spark, d, "region").selectExpr("concat('src', r_regionkey, '.example.org') AS domain", "r_name AS organizer", "array('SRC', upper(r_name)) AS keywords")
    return rules.apply_rules(normalize.apply_defaults(df, patches, ["organizer"]), RULES)


_STATS = """, c AS (SELECT *, regexp_replace(regexp_extract(url, '://([^/]*)', 1), '^www\\.', '') AS domain FROM ev WHERE NOT (organizer LIKE '%7' AND location_name = 'NATION_3')),
v AS (SELECT domain, name LIKE 'BUILDING%' AS bad, NOT regexp_matches(url, '^https://src') AS warned FROM c)
SELECT *, round(100 * valid / total, 1) AS valid_pct, round(100 * invalid / total, 1) AS invalid_pct, round(100 * warned / total, 1) AS warned_pct FROM (
SELECT domain, count(*) AS total, count(*) FILTER (NOT bad) AS valid, count(*) FILTER (bad) AS invalid, count(*) FILTER (warned) AS warned FROM v GROUP BY 1)"""


@query("curation_stats", _STATS)
def curation_stats(spark, d):
    """The whole plan with statistics by domain."""
    df = validate.validate_records(curate(spark, d), CHECKS).withColumn("domain", normalize.url_domain(F.col("url")))
    return validate.validation_stats(df, ["domain"])


@query("curation_tags", f""", k AS (SELECT *, {_KM.replace('FROM ev', 'FROM ev WHERE NOT (organizer LIKE $$%7$$ AND location_name = $$NATION_3$$)')})
SELECT tag, count(*) AS n FROM (SELECT unnest(list_concat(list_sort(list_distinct(list_concat(CASE WHEN keywords IS NOT NULL AND km > 50 AND lat <> 0 AND lng <> 0 THEN list_append(keywords, 'FAR') ELSE coalesce(keywords, []) END, ['SRC', upper(r_name)]))),
list_filter([CASE WHEN name LIKE '%URGENT%' THEN 'URGENT' END, CASE WHEN url LIKE '%src2.%' THEN 'SRC2' END, CASE WHEN name LIKE '%URGENT%' THEN 'URGENT-MULTIDAY' END, CASE WHEN url NOT LIKE '%src2.%' AND location_name LIKE '%_1_' THEN 'TEENS' END], lambda x: x IS NOT NULL))) AS tag
FROM k JOIN region ON contains(url, 'src' || r_regionkey || '.')) GROUP BY 1""")
def curation_tags(spark, d):
    """How often each keyword stands after the whole plan."""
    return validate.tag_counts(curate(spark, d))
