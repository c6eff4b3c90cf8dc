"""Search and evaluation statistics on the driver's tables: events as runs of cases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import nearest_rank
from ..guard import Tools
from ..operators import bm25 as search
from ..operators import evaluation as ev
from .registry import query, read

RUNS = "runs AS (SELECT user_id AS case_id, event_id % 3 AS run, event_type AS family, value, value < 25 AS correct FROM events)"
BEFORE = "b AS (SELECT * FROM runs WHERE run < 3 AND value >= 0)"


def runs(spark, d) -> DataFrame:
    v = F.col("value")
    return read(spark, d, "events").select(F.col("user_id").alias("case_id"), (F.col("event_id") % 3).alias("run"), F.col("event_type").alias("family"), "value", (v < 25).alias("correct"), F.col("event_id"))


@query("score_case", "SELECT event_id, abs(value * 1.0005::DOUBLE - value) <= 1e-4::DOUBLE OR abs(value * 1.0005::DOUBLE - value) <= abs(value) * 1e-3::DOUBLE AS ratio_ok, event_id % 2 = 0 AS label_ok FROM events")
def score_case(spark, d):
    got = F.col("value") * F.lit(1.0005)
    label = F.when(F.col("event_id") % 2 == 0, F.upper("event_type")).otherwise("other")
    return read(spark, d, "events").select("event_id", ev.number_matches(got, F.col("value"), "ratio").alias("ratio_ok"), ev.label_matches(label, F.col("event_type")).alias("label_ok"))


WILSON = "round(greatest(0, (r / n + 3.841458820694124 / (2 * n) - 1.959963984540054 * sqrt(r / n * (1 - r / n) / n + 3.841458820694124 / (4 * n * n))) / (1 + 3.841458820694124 / n)), 9) AS low, round(least(1, (r / n + 3.841458820694124 / (2 * n) + 1.959963984540054 * sqrt(r / n * (1 - r / n) / n + 3.841458820694124 / (4 * n * n))) / (1 + 3.841458820694124 / n)), 9) AS high"


@query("wilson", f"WITH {RUNS}, x AS (SELECT family, count(*)::DOUBLE AS n, (count(*) FILTER (correct))::DOUBLE AS r FROM runs GROUP BY 1) SELECT family, {WILSON} FROM x")
def wilson(spark, d):
    return ev.accuracy(runs(spark, d), "family").select("family", F.round("low", 9).alias("low"), F.round("high", 9).alias("high"))


@query("summarize_by", f"WITH {RUNS} SELECT coalesce(family, '') AS family, coalesce(CAST(run AS VARCHAR), '') AS run, count(*) AS n, count(*) FILTER (correct) AS correct FROM runs GROUP BY GROUPING SETS ((), (family), (run), (family, run))")
def summarize_by(spark, d):
    held = runs(spark, d).cube("family", "run").agg(F.count("*").alias("n"), F.count_if("correct").alias("correct"))
    return held.select(F.coalesce("family", F.lit("")).alias("family"), F.coalesce(F.col("run").cast("string"), F.lit("")).alias("run"), "n", "correct")


@query("p95_nearest_rank", f"WITH {RUNS} SELECT family, list_sort(list(value))[CAST(ceil(0.95 * count(*)) AS BIGINT)] AS p95, round(avg(value), 6) AS mean, round(median(value), 6) AS middle FROM runs GROUP BY 1")
def p95_nearest_rank(spark, d):
    return runs(spark, d).groupBy("family").agg(F.expr("percentile_disc(0.95) within group (order by value)").alias("p95"), F.round(F.avg("value"), 6).alias("mean"), F.round(F.median("value"), 6).alias("middle"))


MAJORITY = "m AS (SELECT case_id, 2 * count(*) FILTER (correct) > count(*) AS majority, CASE WHEN count(*) FILTER (correct) = count(*) THEN 'every' WHEN count(*) FILTER (correct) = 0 THEN 'none' ELSE 'some' END AS stability FROM runs GROUP BY 1)"


@query("majority", f"WITH {RUNS}, {MAJORITY} SELECT * FROM m")
def majority(spark, d):
    return ev.majority(runs(spark, d))


@query("moves", f"WITH {RUNS}, a AS (SELECT case_id, 2 * count(*) FILTER (correct) > count(*) AS was FROM runs WHERE run < 2 GROUP BY 1), b AS (SELECT case_id, 2 * count(*) FILTER (correct) > count(*) AS isnow FROM runs WHERE run > 0 GROUP BY 1) SELECT case_id, CASE WHEN was AND isnow THEN 'stayed right' WHEN NOT was AND NOT isnow THEN 'stayed wrong' WHEN isnow THEN 'fixed' ELSE 'broke' END AS move FROM a JOIN b USING (case_id)")
def moves(spark, d):
    r = runs(spark, d)
    return ev.moves(r.filter("run < 2"), r.filter("run > 0"))


#: Mean, number of cases, and the ends of the normal interval in standard errors, from closed forms.
INTERVAL_SQL = "round(avg(s), 6) AS {name}, count(*) AS least_drawn, count(*) AS most_drawn, round(sqrt(var_pop(s) / count(*)), 9) AS standard_error, round((avg(s) - 1.959963984540054 * sqrt(var_pop(s) / count(*)) - avg(s)) / sqrt(var_pop(s) / count(*)))::BIGINT AS low_errors, round((avg(s) + 1.959963984540054 * sqrt(var_pop(s) / count(*)) - avg(s)) / sqrt(var_pop(s) / count(*)))::BIGINT AS high_errors"
#: Draws of the two bootstraps: the ends of an interval are then good to an eighth of an error.
DRAWS = 400


def _in_errors(found, name):
    away = lambda c: F.round((F.col(c) - F.col(name)) / F.col("standard_error")).cast("long").alias(f"{c}_errors")
    return found.select(F.round(name, 6).alias(name), "least_drawn", "most_drawn", F.round("standard_error", 9).alias("standard_error"), away("low"), away("high"))


@query("bootstrap_cluster", f"WITH {RUNS}, c AS (SELECT case_id, avg(CASE WHEN correct THEN 1.0 ELSE 0.0 END) AS s FROM runs GROUP BY 1) SELECT {INTERVAL_SQL.format(name='accuracy')} FROM c")
def bootstrap_cluster(spark, d):
    """Every draw takes exactly as many cases as there are; the interval is held against the normal
    one of the closed-form error."""
    return _in_errors(ev.bootstrap(runs(spark, d), DRAWS), "accuracy")


@query("paired_bootstrap_diff", f"WITH {RUNS}, a AS (SELECT case_id, avg(CASE WHEN correct THEN 1.0 ELSE 0.0 END) AS s FROM runs WHERE run = 0 GROUP BY 1), b AS (SELECT case_id, avg(CASE WHEN correct THEN 1.0 ELSE 0.0 END) AS s FROM runs WHERE run = 1 GROUP BY 1), c AS (SELECT b.s - a.s AS s FROM a JOIN b USING (case_id)) SELECT {INTERVAL_SQL.format(name='difference')} FROM c")
def paired_bootstrap_diff(spark, d):
    r = runs(spark, d)
    return _in_errors(ev.paired_difference(r.filter("run = 0"), r.filter("run = 1"), DRAWS), "difference")


@query("spread_guards", f"WITH {RUNS}, p AS (SELECT run, count(*) FILTER (correct) AS r FROM runs GROUP BY 1) SELECT min(r) AS least, max(r) AS most, greatest(1, max(r) - min(r)) AS margin FROM p")
def spread_guards(spark, d):
    return ev.spread_margin(runs(spark, d))


@query("kappa", "WITH c AS (SELECT quality, toxic FROM labels), t AS (SELECT count(*)::DOUBLE AS n, count(*) FILTER (quality = toxic)::DOUBLE / count(*) AS po FROM c), e AS (SELECT (sum(a.n * b.n) / max(t.n * t.n))::DOUBLE AS pe FROM (SELECT quality AS l, count(*) AS n FROM c GROUP BY 1) a JOIN (SELECT toxic AS l, count(*) AS n FROM c GROUP BY 1) b USING (l), t) SELECT n::BIGINT AS total, round(po, 9) AS agreement, round((po - pe) / (1 - pe), 9) AS kappa FROM t, e")
def kappa(spark, d):
    found = ev.kappa(read(spark, d, "labels"), "quality", "toxic")
    return found.select("total", F.round("agreement", 9).alias("agreement"), F.round("kappa", 9).alias("kappa"))


QUOTA = "z AS (SELECT o_orderpriority AS stratum, count(*) AS size FROM orders GROUP BY 1), x AS (SELECT *, size * 77.0::DOUBLE / sum(size) OVER () AS exact FROM z), q AS (SELECT stratum, floor(exact)::BIGINT + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, stratum) <= 77 - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS quota FROM x)"


@query("stratified_sample", f"WITH {QUOTA} SELECT o_orderkey FROM (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) AS place FROM orders) JOIN q ON stratum = o_orderpriority WHERE place <= quota")
def stratified_sample(spark, d):
    pick = F.md5(F.col("o_orderkey").cast("string").cast("binary"))
    return ev.stratified(read(spark, d, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", "o_orderkey", 77, pick).select("o_orderkey")


@query("round_robin_sample", "SELECT event_id FROM (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS turn FROM events) ORDER BY turn, event_type LIMIT 13")
def round_robin_sample(spark, d):
    return ev.round_robin(read(spark, d, "events").select("event_id", "event_type"), "event_type", "event_id", 13).select("event_id")


@query("regression_gate", f"WITH {RUNS} SELECT count(DISTINCT case_id) AS cases, 0 AS errors, count(*) FILTER (NOT correct) AS wrong, round(sum(value), 4) AS cost, count(DISTINCT case_id) = 150 AND count(*) FILTER (NOT correct) <= 10 AS passed FROM runs")
def regression_gate(spark, d):
    rows = runs(spark, d).withColumn("error", F.lit(False)).withColumn("cost", F.col("value"))
    found = ev.gate(rows, 150, 10, 1e12)
    return found.select("cases", F.col("errors").cast("int").alias("errors"), "wrong", F.round("cost", 4).alias("cost"), "passed")


@query("cost_routers", """WITH r AS (SELECT value < 25 AS cr, value < 60 AS sr, 1.0::DOUBLE AS cc, 5.0::DOUBLE AS sc, event_id % 4 <> 0 AS sure FROM events),
w AS (SELECT 'cheap' AS way, cr AS ok, cc AS cost FROM r UNION ALL SELECT 'strong', sr, sc FROM r UNION ALL SELECT 'oracle', cr OR sr, CASE WHEN cr OR NOT sr THEN cc ELSE sc END FROM r UNION ALL SELECT 'cascade', CASE WHEN sure THEN cr ELSE sr END, cc + CASE WHEN sure THEN 0 ELSE sc END FROM r)
SELECT way, round(avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END), 9) AS accuracy, round(avg(cost), 9) AS cost FROM w GROUP BY 1""")
def cost_routers(spark, d):
    v = F.col("value")
    rows = read(spark, d, "events").select((v < 25).alias("cheap_right"), (v < 60).alias("strong_right"), F.lit(1.0).alias("cheap_cost"), F.lit(5.0).alias("strong_cost"), (F.col("event_id") % 4 != 0).alias("cheap_sure"))
    return ev.routers(rows).select("way", F.round("accuracy", 9).alias("accuracy"), F.round("cost", 9).alias("cost"))


@query("cost_usd", "SELECT event_id, CAST((CAST(event_id AS HUGEINT) * 25 + user_id * 125) AS DOUBLE) / 100000000 AS usd FROM events")
def cost_usd(spark, d):
    usd = ev.cost_usd({"input": F.col("event_id"), "output": F.col("user_id")}, {"input": "0.25", "output": "1.25"})
    return read(spark, d, "events").select("event_id", usd.cast("double").alias("usd"))


@query("cost_rows", f"WITH {RUNS}, p AS (SELECT run, sum(value) / count(*) AS each FROM runs GROUP BY 1) SELECT round(avg(each), 6) AS mean, round(min(each), 6) AS low, round(max(each), 6) AS high, (SELECT round(sum(value) / count(*) FILTER (correct), 6) FROM runs) AS per_correct FROM p")
def cost_rows(spark, d):
    r = runs(spark, d)
    per = r.groupBy("run").agg((F.sum("value") / F.count("*")).alias("each")).agg(F.round(F.avg("each"), 6).alias("mean"), F.round(F.min("each"), 6).alias("low"), F.round(F.max("each"), 6).alias("high"))
    return per.crossJoin(F.broadcast(r.agg(F.round(F.sum("value") / F.count_if("correct"), 6).alias("per_correct"))))  # one row


@query("rescore", f"WITH {RUNS} SELECT case_id, run, family, count(*) AS flips FROM runs WHERE correct <> (value < 30) GROUP BY 1, 2, 3")
def rescore(spark, d):
    """Stored verdicts against a new rule: what flips."""
    r = runs(spark, d).withColumn("again", F.col("value") < 30)
    return r.filter(F.col("correct") != F.col("again")).groupBy("case_id", "run", "family").agg(F.count("*").alias("flips"))


@query("family_counts", f"WITH {RUNS} SELECT family, count(*) AS refused FROM runs WHERE value > 100 GROUP BY 1")
def family_counts(spark, d):
    return runs(spark, d).filter("value > 100").groupBy("family").agg(F.count("*").alias("refused"))


@query("label_agreement", "WITH s AS (SELECT user_id, list_sort(list(DISTINCT event_type) FILTER (event_id % 2 = 0)) AS a, list_sort(list(DISTINCT event_type) FILTER (event_id % 2 = 1)) AS b FROM events GROUP BY 1) SELECT count(*) AS cases, count(*) FILTER (a = b) AS same FROM s")
def label_agreement(spark, d):
    half = lambda n: F.array_sort(F.collect_set(F.when(F.col("event_id") % 2 == n, F.col("event_type"))))
    sets = read(spark, d, "events").groupBy("user_id").agg(half(0).alias("a"), half(1).alias("b"))
    return sets.agg(F.count("*").alias("cases"), F.count_if(F.col("a") == F.col("b")).alias("same"))


@query("rag_facts", "SELECT item_id, regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g') LIKE '%the%' AND (regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g') LIKE '%tion%' OR regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g') LIKE '%schung%') AS all_facts FROM benchmark")
def rag_facts(spark, d):
    """Every key fact has one of its terms in the normalised answer."""
    plain = F.regexp_replace(F.lower("text"), "[^a-z0-9]+", " ")
    facts = [["the"], ["tion", "schung"]]
    stated = F.array(*[F.array(*[F.lit(t) for t in terms]) for terms in facts])
    return read(spark, d, "benchmark").withColumn("plain", plain).select("item_id", F.forall(stated, lambda fact: F.exists(fact, lambda t: F.contains(F.col("plain"), t))).alias("all_facts"))


@query("label_alteration", "SELECT item_id, coalesce(CAST(regexp_extract('id ' || item_id || ' text', '[0-9]+') AS BIGINT), 0) * 137 + 300 AS altered FROM benchmark")
def label_alteration(spark, d):
    """A planted error: the first number times 1.37 plus 3 (in hundredths here)."""
    text = F.concat(F.lit("id "), F.col("item_id").cast("string"), F.lit(" text"))
    return read(spark, d, "benchmark").select("item_id", (F.regexp_extract(text, "[0-9]+", 0).cast("long") * 137 + 300).alias("altered"))


STOP = ", ".join(f"'{w}'" for w in search.STOP)
TERMS = "list_filter(regexp_extract_all(lower(coalesce({t}, '')), '[\\p{{L}}\\p{{N}}_]+'), lambda w: w NOT IN ({s}))"
BM25 = f"""WITH c AS (SELECT item_id AS chunk_id, regexp_extract(coalesce(text, ''), '^[^.\n]*') AS heading, coalesce(text, '') AS text FROM benchmark), k AS (SELECT chunk_id, flatten(list_transform(range(8), lambda i: {TERMS.format(t='heading', s=STOP)})) || {TERMS.format(t='text', s=STOP)} AS words FROM c),
l AS (SELECT chunk_id, len(words) AS length FROM k), p AS (SELECT term, chunk_id, count(*) AS tf FROM (SELECT chunk_id, unnest(words) AS term FROM k) GROUP BY 1, 2), df AS (SELECT term, count(*) AS df FROM p GROUP BY 1), t AS (SELECT count(*) AS n, avg(length) AS mean FROM l),
q AS (SELECT query_id, unnest(list_distinct({TERMS.format(t='text', s=STOP)})) AS term FROM (SELECT item_id AS query_id, text FROM benchmark)),
s AS (SELECT query_id, chunk_id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * length / mean))) AS score FROM q JOIN p USING (term) JOIN df USING (term) JOIN l USING (chunk_id), t GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, chunk_id) AS place FROM s)"""


def _searched(spark, d):
    b = read(spark, d, "benchmark")
    index = search.Index(b.select(F.col("item_id").alias("chunk_id"), F.regexp_extract(F.coalesce("text", F.lit("")), r"^[^.\n]*", 0).alias("heading"), F.coalesce("text", F.lit("")).alias("text")))
    asked = b.select(F.col("item_id").alias("query_id"), "text")
    return index.search(asked)


@query("bm25", f"{BM25} SELECT query_id, chunk_id, CAST(place AS INT) AS place, round(score, 6) AS score FROM r WHERE place <= 5")
def bm25(spark, d):
    return _searched(spark, d).select("query_id", "chunk_id", "place", F.round("score", 6).alias("score"))


@query("bm25_sections")
def bm25_sections(spark, d):
    """Sections of all documents, asked for by the whole texts of ids divisible by 100. No oracle:
    the cut is not SQL's; the search is the one above."""
    docs = read(spark, d, "documents")
    index = search.Index(search.sections(docs, "doc_id", "text"))
    asked = docs.filter("doc_id % 100 = 0").select(F.col("doc_id").alias("query_id"), "text")
    return index.search(asked).select("query_id", "chunk_id", F.col("place").cast("int").alias("place"), F.round("score", 6).alias("score"))


@query("retrieval_metrics", f"{BM25} SELECT count(*) AS queries, count(*) FILTER (place <= 5) AS found, round(avg(CASE WHEN place <= 5 THEN 1.0 / place ELSE 0 END), 9) AS mrr FROM (SELECT DISTINCT query_id FROM q) x LEFT JOIN r ON r.query_id = x.query_id AND r.chunk_id = x.query_id")
def retrieval_metrics(spark, d):
    found = _searched(spark, d)
    relevant = read(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), F.col("item_id").alias("chunk_id"))
    return search.retrieval_metrics(found, relevant).withColumn("mrr", F.round("mrr", 9))


# the guarded SQL entry


def tools(spark, d) -> Tools:
    return Tools(spark, {t: read(spark, d, t) for t in ("events", "orders", "nation", "region")})


@query("sql_guard", "SELECT * FROM (VALUES ('plain', true), ('with', true), ('two', false), ('insert', false), ('path', false), ('java', false), ('hint', false), ('comment', true)) t(kind, allowed)")
def sql_guard(spark, d):
    from ..guard import check

    texts = {
        "plain": "SELECT 1", "with": "WITH x AS (SELECT 1 AS a) SELECT a FROM x;", "two": "SELECT 1; SELECT 2", "insert": "INSERT INTO events VALUES (1)",
        "path": "SELECT * FROM parquet.`/tmp/x`", "java": "SELECT java_method('java.lang.System', 'exit', 1)", "hint": "SELECT /*+ BROADCAST(a) */ 1", "comment": "SELECT 1 -- ; DROP TABLE x",
    }
    return spark.createDataFrame([(k, check(t).ok) for k, t in texts.items()], "kind string, allowed boolean")


@query("run_sql", "SELECT n_name, n_regionkey FROM nation ORDER BY n_nationkey LIMIT 7")
def run_sql(spark, d):
    got = tools(spark, d).run_sql("SELECT n_name, n_regionkey FROM nation ORDER BY n_nationkey LIMIT 7")
    return spark.createDataFrame([tuple(r) for r in got["rows"]], "n_name string, n_regionkey int")


@query("describe_schema", "SELECT * FROM (VALUES ('nation', 'n_name', 'string'), ('nation', 'n_nationkey', 'int'), ('nation', 'n_regionkey', 'int'), ('region', 'r_name', 'string'), ('region', 'r_regionkey', 'int')) t(\"table\", name, type)")
def describe_schema(spark, d):
    found = [(t["table"], c["name"], c["type"]) for t in tools(spark, d).describe() if t["table"] in ("nation", "region") for c in t["columns"]]
    return spark.createDataFrame(found, "table string, name string, type string")


@query("coverage", "SELECT strftime(min(ts), '%Y-%m-%d') AS first, strftime(max(ts), '%Y-%m-%d') AS last, count(*) AS rows FROM events")
def coverage(spark, d):
    got = tools(spark, d).coverage("events", "ts")
    return spark.createDataFrame([(got["first"][:10], got["last"][:10], got["rows"])], "first string, last string, rows long")


@query("golden_build", "SELECT * FROM (VALUES ('customers', (SELECT count(*) FROM customer)), ('nations', (SELECT count(*) FROM nation)), ('largest order', (SELECT max(o_orderkey) FROM orders))) t(case_id, answer)")
def golden_build(spark, d):
    """Reference queries run in a batch; their answers become cases."""
    cases = {"customers": ("customer", F.count("*")), "nations": ("nation", F.count("*")), "largest order": ("orders", F.max("o_orderkey"))}
    parts = [read(spark, d, t).agg(a.cast("long").alias("answer")).select(F.lit(name).alias("case_id"), "answer") for name, (t, a) in cases.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("same_rows", "SELECT true AS same, false AS other")
def same_rows(spark, d):
    from ..guard import same_number

    return spark.createDataFrame([(same_number(0.1 + 0.2, 0.3), same_number(0.31, 0.3))], "same boolean, other boolean")


@query("ungrounded_cause", "SELECT * FROM (VALUES (5, 'last result'), (1, 'an earlier result'), (9, 'nowhere')) t(answer, cause)")
def ungrounded_cause(spark, d):
    from ..guard import cause_of_ungrounded

    results = [[[1, "a"]], [[5, "b"]]]
    return spark.createDataFrame([(x, cause_of_ungrounded(x, results)) for x in (5, 1, 9)], "answer int, cause string")
