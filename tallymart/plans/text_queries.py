"""Queries on names, texts, pages and vectors."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallymart.functions import text as T
from tallymart.operators import search
from tallymart.plans.catalog import register
from tallymart.sources.tables import table

_STOP = "[" + ", ".join(f"'{w}'" for w in T.NAME_STOPWORDS) + "]"
_TOKENS = f"list_distinct(list_filter(string_split(trim(regexp_replace(lower({{0}}), '[^a-z0-9_]+', ' ', 'g')), ' '), lambda t: length(t) > 1 AND NOT list_contains({_STOP}, t)))"


@register("normalize_name", "SELECT doc_id, md5(trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9_]+', ' ', 'g'))) AS name_md5 FROM documents")
def normalize_name(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(T.normalize_name(F.coalesce("text", F.lit("")))).alias("name_md5"))


@register("keyword_index", f"SELECT token, count(*) AS n_docs FROM (SELECT unnest({_TOKENS.format('text')}) AS token FROM documents) GROUP BY token")
def keyword_index(spark, sf):
    return table(spark, sf, "documents").select(F.explode(T.name_tokens(F.col("text"))).alias("token")).groupBy("token").agg(F.count("*").alias("n_docs"))


@register(
    "token_jaccard_pairs",
    f"""WITH b AS (SELECT item_id AS id, {_TOKENS.format('text')} AS t FROM benchmark), p AS (SELECT a.id AS id1, c.id AS id2, len(list_intersect(a.t, c.t)) / len(list_distinct(list_concat(a.t, c.t))) AS s FROM b a JOIN b c ON a.id < c.id)
 SELECT id1, id2, floor(s * 1000000 + 0.5) / 1000000 AS score FROM p WHERE s >= 0.2""",
)
def token_jaccard_pairs(spark, sf):
    b = table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), T.name_tokens(F.col("text")).alias("tokens"))
    return search.token_pairs(b, b, T.jaccard, 0.2).select("id1", "id2", T.rounded(F.col("score"), 1_000_000).alias("score"))


@register(
    "search_rank",
    """SELECT p_partkey AS id, CASE WHEN p_name = 'cold widget' THEN 1 WHEN list_contains(string_split(p_name, ' '), 'cold') AND list_contains(string_split(p_name, ' '), 'widget') THEN 2 ELSE 3 END AS tier,
 rank() OVER (PARTITION BY p_brand ORDER BY CASE WHEN p_name = 'cold widget' THEN 1 WHEN list_contains(string_split(p_name, ' '), 'cold') AND list_contains(string_split(p_name, ' '), 'widget') THEN 2 ELSE 3 END, length(p_name), p_name, p_partkey) AS place
 FROM part WHERE len(list_filter(string_split(p_name, ' '), lambda t: starts_with(t, 'cold') OR starts_with(t, 'widget'))) > 0""",
)
def search_rank(spark, sf):
    """Q4/Q5 within each brand; a page is `place <= n`."""
    p = table(spark, sf, "part").withColumn("tier", search.rank_tier(F.col("p_name"), F.split("p_name", " "), "cold widget")).where("tier IS NOT NULL")
    w = Window.partitionBy("p_brand").orderBy("tier", F.length("p_name"), "p_name", "p_partkey")
    return p.select(F.col("p_partkey").alias("id"), "tier", F.rank().over(w).cast("long").alias("place"))


@register("variant_signature", "SELECT p_partkey AS id, list_max(list_concat(list_transform(regexp_extract_all(lower(title), '([0-9]+) ?gb', 1), lambda x: x::BIGINT), list_transform(regexp_extract_all(lower(title), '([0-9]+) ?tb', 1), lambda x: x::BIGINT * 1024))) AS storage FROM (SELECT p_partkey, p_name || ' 8GB RAM ' || p_size || CASE WHEN p_size % 5 = 0 THEN 'TB' ELSE 'GB' END AS title FROM part)")
def variant_signature(spark, sf):
    title = F.concat("p_name", F.lit(" 8GB RAM "), "p_size", F.when(F.col("p_size") % 5 == 0, "TB").otherwise("GB"))
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), T.storage_gb(title).alias("storage"))


@register(
    "grocery_match_key",
    """SELECT p_partkey AS id, CASE WHEN p_size % 3 > 0 THEN array_to_string(list_sort(list_distinct(list_filter(string_split(p_name, ' '), lambda t: length(t) > 1 AND t <> 'new'))), ' ') || '#' ||
 CASE WHEN p_size % 3 = 1 THEN '4x' || p_size || 'ml' ELSE array_to_string(list_sort(['6pc', p_size || 'g']), ',') END END AS match_key FROM part""",
)
def grocery_match_key(spark, sf):
    """T23 on titles with a multipack, with a size and a count, or with neither; the SQL states the keys directly."""
    p = table(spark, sf, "part")
    title = F.when(F.col("p_size") % 3 == 0, F.col("p_name")).when(F.col("p_size") % 3 == 1, F.concat(F.lit("Fresh "), "p_name", F.lit(" 4 x "), "p_size", F.lit("ML"))).otherwise(F.concat("p_name", F.lit(" "), "p_size", F.lit("g 6 pcs")))
    return p.select(F.col("p_partkey").alias("id"), T.grocery_match_key(title).alias("match_key"))


@register(
    "price_tier_tags",
    "SELECT o_orderkey AS id, CASE WHEN p < 200 THEN 'budget' WHEN p < 500 THEN 'affordable' WHEN p < 1500 THEN 'mid-range' WHEN p < 5000 THEN 'premium' WHEN p IS NOT NULL THEN 'luxury' END AS tier FROM (SELECT o_orderkey, o_totalprice / 50 AS p FROM orders)",
)
def price_tier_tags(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), T.price_tier(F.col("o_totalprice") / 50).alias("tier"))


@register("canonical_url", r"SELECT page_id, lower(regexp_replace(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', ''), '^(https?://)(www\.)?', 'https://')) AS canonical FROM pages")
def canonical_url(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.canonical_url(F.col("url")).alias("canonical"))


@register("html_links", """SELECT page_id, unnest(list_distinct(regexp_extract_all(html, 'href="([^"#?]+)', 1))) AS link FROM pages""")
def html_links(spark, sf):
    """Distinct link targets of a listing, without query and fragment."""
    return table(spark, sf, "pages").select("page_id", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit('href="([^"#?]+)'), F.lit(1)))).alias("link"))


@register(
    "localized_pick",
    """WITH t AS (SELECT conv_id, turn // 2 AS pair, max(CASE WHEN role = 'user' AND trim(text) <> '' THEN text END) AS u, max(CASE WHEN role = 'assistant' AND trim(text) <> '' THEN text END) AS a FROM conversations GROUP BY ALL)
 SELECT conv_id, pair, md5(coalesce(a, u)) AS text_md5, a IS NULL AS fallback FROM t WHERE coalesce(a, u) IS NOT NULL""",
)
def localized_pick(spark, sf):
    """The wanted locale where it is not blank, else the other, marked."""
    said = lambda role: F.max(F.when((F.col("role") == role) & (F.trim("text") != ""), F.col("text")))
    c = table(spark, sf, "conversations").groupBy("conv_id", F.floor(F.col("turn") / 2).alias("pair")).agg(said("user").alias("u"), said("assistant").alias("a"))
    return c.where(F.coalesce("a", "u").isNotNull()).select("conv_id", "pair", F.md5(F.coalesce("a", "u")).alias("text_md5"), F.col("a").isNull().alias("fallback"))


@register(
    "anchor_mean_tagging",
    """WITH m AS (SELECT label, i, avg(embedding[i]::DOUBLE) AS x FROM (SELECT label, embedding, unnest(range(1, 65)) AS i FROM embeddings) GROUP BY ALL), n AS (SELECT label, sqrt(sum(x * x)) AS norm FROM m GROUP BY label)
 SELECT label, i::INT AS i, floor(x / norm * 1000000 + 0.5)::BIGINT AS millionths FROM m JOIN n USING (label)""",
)
def anchor_mean_tagging(spark, sf):
    """Mean vector of each tag, scaled to length one."""
    e = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    m = e.groupBy("label", (F.col("i") + 1).alias("i")).agg(F.avg(F.col("x").cast("double")).alias("x"))
    norm = m.groupBy("label").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    return m.join(norm, "label").select("label", "i", F.floor(F.col("x") / F.col("norm") * 1_000_000 + 0.5).alias("millionths"))


@register(
    "cosine_topk_filtered",
    """WITH q AS (SELECT embedding AS v FROM embeddings WHERE vec_id = 0), s AS (SELECT vec_id, label, list_dot_product(embedding::DOUBLE[], v::DOUBLE[]) / (sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) * sqrt(list_dot_product(v::DOUBLE[], v::DOUBLE[]))) AS s FROM embeddings, q WHERE label < 5)
 SELECT vec_id, label, floor(s * 1000000 + 0.5)::BIGINT AS millionths FROM s ORDER BY s.s DESC, vec_id LIMIT 20""",
)
def cosine_topk_filtered(spark, sf):
    """Exact top 20 of one query vector among the rows that pass the filter."""
    e = table(spark, sf, "embeddings")
    q = e.where("vec_id = 0").select("embedding").first()
    v = F.array(*[F.lit(float(x)) for x in q[0]])
    s = e.where("label < 5").select("vec_id", "label", search.cosine(F.col("embedding"), v).alias("s")).orderBy(F.desc("s"), "vec_id").limit(20)
    return s.select("vec_id", "label", F.floor(F.col("s") * 1_000_000 + 0.5).alias("millionths"))
