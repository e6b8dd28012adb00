"""Queries of metrics, windows, sampling, sets, extraction, retrieval, sources and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import schema as J
from corpusloom.functions import text as X
from corpusloom.functions import udfs as U
from corpusloom.functions import wordlists as W
from corpusloom.operators import extract as E
from corpusloom.operators import metrics as M
from corpusloom.operators import retrieval as R
from corpusloom.operators import sampling as L
from corpusloom.operators import sets as Z
from corpusloom.operators import windows as N
from corpusloom.plans import sqlparts as S
from corpusloom.plans.registry import query
from corpusloom.sources import io
from corpusloom.streaming import streams

c = F.col

# ---- aggregations and metrics


@query("a2_categories", "SELECT coalesce(lang, '?') AS value, count(*) n FROM train_smoke GROUP BY 1")
def _(t):
    return M.histogram(t.train_smoke, c("lang"))


@query("a3_kept_by_source", "SELECT source, scanned, kept, round(100.0 * kept / sum(kept) OVER (), 4) percent FROM (SELECT coalesce(source, '?') source, count(*) scanned, count(*) FILTER (n_chars >= 300) kept FROM documents GROUP BY 1)")
def _(t):
    return M.kept_by_source(t.documents, c("source"), c("n_chars") >= 300)


@query("a4_mean_chars", "SELECT src, round(sum(length(coalesce(instruction, '')) + length(coalesce(response, ''))) / greatest(1, count(*)), 4) mean_chars FROM train_smoke GROUP BY src")
def _(t):
    return t.train_smoke.groupBy("src").agg(F.round(F.sum(F.length(F.coalesce("instruction", F.lit(""))) + F.length(F.coalesce("response", F.lit("")))) / F.greatest(F.lit(1), F.count("*")), 4).alias("mean_chars"))


@query("a5_conditional_shares", f"SELECT lang, round(avg(CASE WHEN {S.n_words(S.text('response'))} <= 22 THEN 1.0 ELSE 0.0 END), 6) short_share, round(avg(CASE WHEN {S.f3(S.text('response'))} > 0.5 THEN 1.0 ELSE 0.0 END), 6) script_share FROM train_smoke GROUP BY lang")
def _(t):
    r = F.coalesce(c("response"), F.lit(""))
    return t.train_smoke.groupBy("lang").agg(F.round(F.avg((X.word_count(r) <= 22).cast("double")), 6).alias("short_share"), F.round(F.avg((X.script_share_of_marked(r) > 0.5).cast("double")), 6).alias("script_share"))


@query("a6_surface_forms", f"SELECT count(DISTINCT f) forms FROM (SELECT unnest(regexp_extract_all(coalesce(response, ''), '[{S.DEV}]+')) f FROM train_smoke)")
def _(t):
    forms = t.train_smoke.select(F.explode(F.regexp_extract_all(F.coalesce("response", F.lit("")), F.lit(f"([{X.DEVANAGARI}]+)"), F.lit(1))).alias("f"))
    return forms.agg(F.countDistinct("f").alias("forms"))


@query("a7_topics", "SELECT topic AS value, count(*) n FROM (SELECT " + S.case([(S.has("s", rf"(?i)\b({a})\b|({b})"), k) for k, (a, b) in W.TOPICS.items()]).removesuffix(" END") + " ELSE 'other' END topic FROM (SELECT left(coalesce(instruction, '') || ' ' || coalesce(response, ''), 400) s FROM train_smoke)) GROUP BY 1")
def _(t):
    return M.histogram(t.train_smoke.select(M.topic(c("instruction"), c("response"), W.TOPICS).alias("topic")), c("topic"))


@query("a8_largest_share", "SELECT max(n)::double / sum(n) largest_share, count(*) AS groups FROM (SELECT source, count(*) n FROM documents GROUP BY 1)")
def _(t):
    return M.largest_share(t.documents.groupBy("source").agg(F.count("*").alias("n")))


@query("a9_percentiles", """SELECT event_type, list_sort(list(value))[least(count(*), floor(count(*) * 0.9)::bigint + 1)] floor90, quantile_disc(value, 0.5) nearest50, round(quantile_cont(value, 0.9), 6) interpolated90, list_sort(list(value))[least(count(*), floor(count(*) * 0.5)::bigint + 1)] upper_median FROM events WHERE value IS NOT NULL GROUP BY event_type""")
def _(t):
    p = M.percentiles(t.events, ["event_type"], "value", {"floor90": ("floor", 0.9), "nearest50": ("nearest", 0.5), "interpolated90": ("interpolated", 0.9), "upper_median": ("floor", 0.5)})
    return p.withColumn("interpolated90", F.round("interpolated90", 6))


@query("a10_shares", "SELECT o_orderpriority, n_rows, weight, round(100.0 * n_rows / sum(n_rows) OVER (), 4) row_percent, round(100.0 * weight / sum(weight) OVER (), 4) weight_percent FROM (SELECT o_orderpriority, count(*) n_rows, sum(length(o_orderstatus) + o_orderkey % 7)::bigint weight FROM orders GROUP BY 1)")
def _(t):
    return M.shares(t.orders, ["o_orderpriority"], F.length("o_orderstatus") + c("o_orderkey") % 7)


@query("a11_tool_summary", "SELECT event_type, count(*) calls, count(*) FILTER (user_id % 2 = 0) succeeded, count(*) FILTER (user_id % 2 = 1) failed, coalesce(sum(event_id % 100), 0)::bigint ms FROM events GROUP BY 1")
def _(t):
    return M.tool_summary(t.events.select("event_type", F.when(c("user_id") % 2 == 0, "success").otherwise("error").alias("status"), (c("event_id") % 100).alias("ms")), ["event_type"])


@query("a13_threads", "SELECT user_id, count(*) messages, arg_min(event_type, (ts, event_id)) subject, min(ts) first_at, max(ts) last_at, count(DISTINCT event_type) participants, count(DISTINCT event_type) subjects FROM events GROUP BY user_id")
def _(t):
    e = t.events.withColumn("at", F.struct("ts", "event_id"))
    return M.thread_summary(e, "user_id", c("event_type"), "at", "event_type").withColumn("first_at", c("first_at.ts")).withColumn("last_at", c("last_at.ts"))


@query("a14_session_totals", "SELECT key, turns::bigint turns, coalesce(sum(tokens), 0)::bigint tokens FROM oasst_v8 GROUP BY key, turns")
def _(t):
    return t.oasst_v8.groupBy("key", c("turns").cast("long").alias("turns")).agg(F.coalesce(F.sum("tokens"), F.lit(0)).cast("long").alias("tokens"))


@query("a15_accuracy", "SELECT rater, round(avg(CASE WHEN (quality >= 2) = (toxic = 0) THEN 1.0 ELSE 0.0 END), 6) accuracy, count(*) n FROM labels WHERE quality IS NOT NULL AND toxic IS NOT NULL GROUP BY rater")
def _(t):
    ok = t.labels.where("quality is not null and toxic is not null")
    return ok.groupBy("rater").agg(F.round(F.avg(((c("quality") >= 2) == (c("toxic") == 0)).cast("double")), 6).alias("accuracy"), F.count("*").alias("n"))


@query("a16_pass_rates", "SELECT event_type, count(*) tasks, round(avg(rate), 6) pass_rate, round(avg(deviation), 4) deviation, round(avg(mean), 4) mean_duration FROM (SELECT event_type, user_id, avg(CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END) rate, coalesce(stddev_samp(value), 0) deviation, avg(value) mean FROM events GROUP BY 1, 2) GROUP BY 1")
def _(t):
    r = M.pass_rates(t.events.select("event_type", "user_id", (c("value") > 50).alias("passed"), c("value").alias("duration")), "user_id", ["event_type"])
    return r.select("event_type", "tasks", F.round("pass_rate", 6).alias("pass_rate"), F.round("deviation", 4).alias("deviation"), F.round("mean_duration", 4).alias("mean_duration"))


@query("a17_layers", "SELECT event_type, count(*) calls, count(*) FILTER (event_id % 2 = 0) parseable, count(*) FILTER (event_id % 2 = 0 AND event_id % 3 = 0) named, count(*) FILTER (event_id % 30 = 0) exact FROM events GROUP BY 1")
def _(t):
    i = c("event_id")
    return M.layered(t.events.select("event_type", (i % 2 == 0).alias("parseable"), (i % 3 == 0).alias("name_ok"), (i % 5 == 0).alias("args_ok")), ["event_type"])


@query("a18_confusion", "WITH d AS (SELECT quality t, CASE WHEN toxic = 1 THEN 0 ELSE 3 END p FROM labels WHERE quality IS NOT NULL), k AS (SELECT t v FROM d UNION SELECT p FROM d) SELECT a.v::int truth, b.v::int predicted, (SELECT count(*) FROM d WHERE t = a.v AND p = b.v) n FROM k a, k b")
def _(t):
    d = t.labels.where("quality is not null").select("quality", F.when(c("toxic") == 1, 0).otherwise(3).alias("p"))
    return M.confusion(d, "quality", "p")


@query("a19_precision_recall", """SELECT rater, tp, fp, fn, round(coalesce(tp / nullif(tp + fp, 0)::double, 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0)::double, 0), 6) recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::double, 0), 6) f1
 FROM (SELECT rater, count(*) FILTER (quality >= 2 AND toxic = 0) tp, count(*) FILTER (quality < 2 AND toxic = 0) fp, count(*) FILTER (quality >= 2 AND toxic <> 0) fn FROM labels WHERE quality IS NOT NULL AND toxic IS NOT NULL GROUP BY rater)""")
def _(t):
    ok = t.labels.where("quality is not null and toxic is not null")
    r = M.precision_recall(ok, "rater", c("quality") >= 2, c("toxic") == 0)
    return r.select("rater", "tp", "fp", "fn", *(F.round(x, 6).alias(x) for x in ("precision", "recall", "f1")))


@query("a19_average_precision", """SELECT event_type, round(sum(p / nullif(total, 0)::double * tp / n_all), 6) average_precision FROM (SELECT event_type, value, p, sum(p) OVER w tp, sum(n) OVER w n_all, sum(p) OVER (PARTITION BY event_type) total
 FROM (SELECT event_type, value, count(*) n, count(*) FILTER (user_id % 3 = 0) p FROM events GROUP BY 1, 2) WINDOW w AS (PARTITION BY event_type ORDER BY value DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) GROUP BY 1""")
def _(t):
    r = M.average_precision(t.events.select("event_type", "value", (c("user_id") % 3 == 0).alias("y")), ["event_type"], "value", "y")
    return r.select("event_type", F.round("average_precision", 6).alias("average_precision"))


@query("a20_threshold", "WITH d AS (SELECT least(95, floor(value + 1e-9)) s, value > 60 y FROM events WHERE value IS NOT NULL), g AS (SELECT i / 100.0 t, (SELECT count(*) FILTER (y) FROM d WHERE s >= i) tp, (SELECT count(*) FROM d WHERE s >= i) f, (SELECT count(*) FILTER (y) FROM d) a FROM range(5, 96) r(i)) SELECT t threshold, coalesce(2 * tp / nullif(f + a, 0)::double, 0) f1 FROM g ORDER BY round(f1, 12) DESC, abs(t - 0.5) LIMIT 1")
def _(t):
    return M.tune_threshold(t.events.select((c("value") / 100).alias("score"), (c("value") > 60).alias("y")), "score", "y")


@query("a21_rewards", "SELECT l_orderkey, l_linenumber, 3.0 AS format, 2.0 approximate, CASE WHEN k = l_linenumber THEN 5.0 WHEN k / l_linenumber::double BETWEEN 0.9 AND 1.1 THEN 2.0 WHEN k / l_linenumber::double BETWEEN 0.8 AND 1.2 THEN 1.5 ELSE -2.5 END answer, CASE WHEN k = l_linenumber THEN 3.5 ELSE -1.5 END number FROM (SELECT l_orderkey, l_linenumber, l_quantity::int k FROM lineitem)")
def _(t):
    s = F.concat(F.lit("<start_working_out>x<end_working_out><SOLUTION>"), c("l_quantity").cast("int").cast("string"), F.lit("</SOLUTION>"))
    r = M.rewards(s, c("l_linenumber").cast("string"))
    return t.lineitem.select("l_orderkey", "l_linenumber", *(v.alias(k) for k, v in r.items()))


_book = '{"type": "object", "properties": {"k": {"type": "integer", "minimum": 10}, "z": {"type": "string"}}, "required": ["k", "z"], "additionalProperties": false}'


def _completions(t):
    """Of each part a completion of one of five forms: all there, in a fence, a key too few, a key too many, no JSON."""
    k = c("p_size").cast("string")
    form = c("p_partkey") % 5
    full = F.concat(F.lit('{"k": '), k, F.lit(', "z": "a"'))
    s = F.when(form == 0, F.concat(full, F.lit("}"))).when(form == 1, F.concat(F.lit("x\n```json\n"), full, F.lit("}\n```"))).when(form == 2, F.concat(F.lit('{"k": '), k, F.lit("}"))).when(form == 3, F.concat(full, F.lit(', "q": 1}'))).otherwise("none")
    return t.part.select("p_partkey", s.alias("s"))


@query("a22_count_rewards", "SELECT p_partkey, (CASE p_partkey % 5 WHEN 2 THEN 0.5 WHEN 3 THEN 0.5 WHEN 4 THEN 0.0 ELSE 1.0 END)::double reward FROM part")
def _(t):
    return _completions(t).select("p_partkey", J.fields_reward("s", F.lit(2)).alias("reward"))


@query("a22_format_rewards", "SELECT p_partkey, (CASE p_partkey % 5 WHEN 1 THEN 0.2 WHEN 4 THEN 0.0 ELSE 1.0 END)::double reward FROM part")
def _(t):
    return _completions(t).select("p_partkey", J.format_reward("s", F.lit(False)).alias("reward"))


# Six checks are declared: two properties, two required names, one minimum, one for further names.
@query("a22_schema_rewards", """SELECT p_partkey, round(CASE WHEN f = 4 THEN 0 ELSE 0.75 * (CASE f WHEN 2 THEN 0.5 ELSE 1 END) * (1 - bad / 6.0) + (CASE WHEN bad = 0 THEN 0.25 ELSE 0 END) END, 9)::double reward
 FROM (SELECT p_partkey, p_partkey % 5 f, (CASE WHEN p_size < 10 THEN 1 ELSE 0 END) + (CASE WHEN p_partkey % 5 IN (2, 3) THEN 1 ELSE 0 END) bad FROM part)""")
def _(t):
    return _completions(t).select("p_partkey", F.round(J.schema_reward("s", F.lit(_book)), 9).alias("reward"))


@query("a23_parameter_scores", "SELECT n_nationkey, round(0.3 * (n_nationkey % 2) + 0.3 * 0.5 + 0.3 * 0.5 + 0.1 * 0.75, 6) score FROM nation")
def _(t):
    got, want = F.create_map(F.lit("a"), F.lit("1"), F.lit("z"), F.lit("9")), F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2"))
    return t.nation.select("n_nationkey", F.round(M.parameter_score(c("n_nationkey") % 2 == 1, got, want), 6).alias("score"))


@query("a24_quotas", "SELECT n_nationkey, greatest(1, round_even((1 / (n_nationkey + 0.1)) / (SELECT sum(1 / (n_nationkey + 0.1)) FROM nation) * 500, 0)::bigint) quota FROM nation")
def _(t):
    return M.inverse_quota(t.nation.select("n_nationkey"), "n_nationkey", 500)


@query("a26_run_summary", "SELECT l_orderkey % 50 run, arg_min(l_linenumber, (l_discount, l_linenumber)) best_step, min(l_discount) best, arg_max(l_discount, (l_linenumber, l_discount)) final, round(arg_max(l_discount, (l_linenumber, l_discount)) - min(l_discount), 6) rise, arg_max(l_discount, (l_linenumber, l_discount)) / (arg_max(l_tax, (l_linenumber, l_tax)) + 0.01) > 1.5 overfit FROM lineitem GROUP BY 1")
def _(t):
    s = t.lineitem.select((c("l_orderkey") % 50).alias("run"), c("l_linenumber").alias("step"), c("l_discount").alias("eval"), (c("l_tax") + 0.01).alias("train"))
    return M.run_summary(s, "run").withColumn("rise", F.round("rise", 6))


@query("a27_provenance", f"SELECT count(*) n_rows, list_sort(list(n))[least(count(*), floor(count(*) * 0.5)::bigint + 1)] median_words, list_sort(list(n))[least(count(*), floor(count(*) * 0.9)::bigint + 1)] p90_words, max(n) max_words FROM (SELECT {S.n_words(S.text('response'))} n FROM train_smoke)")
def _(t):
    return M.provenance(t.train_smoke, "response")


@query("a28_ledger", "SELECT o_orderpriority, sum(o_orderkey % 1000)::bigint tokens_in, sum(o_orderkey % 300)::bigint tokens_out, round(sum(CASE WHEN o_orderkey % 4 <> 0 THEN (o_orderkey % 1000) / 1e6 * 0.5 + (o_orderkey % 300) / 1e6 * 1.5 ELSE 0 END), 8) spent, round(sum(CASE WHEN o_orderkey % 4 = 0 THEN (o_orderkey % 1000) / 1e6 * 0.5 + (o_orderkey % 300) / 1e6 * 1.5 ELSE 0 END), 8) saved, round(100 * avg(CASE WHEN o_orderkey % 4 = 0 THEN 1.0 ELSE 0.0 END), 4) percent_local FROM orders GROUP BY 1")
def _(t):
    k = c("o_orderkey")
    return M.token_ledger(t.orders.select("o_orderpriority", k, (k % 1000).alias("i"), (k % 300).alias("o")), ["o_orderpriority"], "i", "o", 0.5, 1.5, k % 4 == 0)


@query("a29_coverage", "SELECT event_type, user_id % 5 stratum, count(*) n FROM events GROUP BY 1, 2")
def _(t):
    return t.events.groupBy("event_type", (c("user_id") % 5).alias("stratum")).agg(F.count("*").alias("n"))


# ---- positions and windows


@query("w02_turns", "SELECT key, list_filter(messages, lambda m: m.role = 'user')[1].content first_user, list_filter(messages, lambda m: m.role = 'assistant')[-1].content last_assistant, messages[-2].content q, messages[-1].content a FROM oasst_v8")
def _(t):
    q, a = N.last_pair(c("messages"))
    return t.oasst_v8.select("key", N.first_by_role(c("messages"), "user").alias("first_user"), N.last_by_role(c("messages"), "assistant").alias("last_assistant"), q.alias("q"), a.alias("a"))


@query("w04_first_valid_pair", "SELECT row_id, CASE WHEN ok THEN trim(instruction, ' ') WHEN trim(coalesce(key, ''), ' ') <> '' THEN trim(key, ' ') END prompt, CASE WHEN ok THEN trim(response, ' ') WHEN trim(coalesce(key, ''), ' ') <> '' THEN trim(key, ' ') END answer FROM (SELECT *, trim(coalesce(instruction, ''), ' ') <> '' AND trim(coalesce(response, ''), ' ') <> '' ok FROM train_smoke)")
def _(t):
    p = N.first_valid_pair(F.array(F.array(F.lit(" "), c("response")), F.array("instruction", "response"), F.array("key", "key")))
    return t.train_smoke.select("row_id", p.alias("p")).select("row_id", "p.prompt", "p.answer")


@query("w05_merged_intervals", """WITH d AS (SELECT o_custkey k, o_orderdate s, o_orderdate + INTERVAL 60 DAY e FROM orders), m AS (SELECT *, max(e) OVER (PARTITION BY k ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) top FROM d),
 b AS (SELECT *, sum(CASE WHEN top IS NULL OR s > top THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY s, e ROWS UNBOUNDED PRECEDING) g FROM m) SELECT k, min(s) s, max(e) e FROM b GROUP BY k, g""")
def _(t):
    return N.merged_intervals(t.orders.select(c("o_custkey").alias("k"), c("o_orderdate").alias("s"), (c("o_orderdate") + F.expr("interval 60 days")).alias("e")), ["k"], "s", "e")


# Busy half hours within 8 and 18 o'clock, merged, and the gaps before, between and after them that last half an hour.
_SLOTS = """WITH b AS (SELECT user_id, ts::date AS day, greatest(ts, ts::date + INTERVAL 8 HOUR) s, least(ts + INTERVAL 30 MINUTE, ts::date + INTERVAL 18 HOUR) e FROM events), d AS (SELECT * FROM b WHERE s < e),
 m AS (SELECT *, max(e) OVER (PARTITION BY user_id, day ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) top FROM d),
 g AS (SELECT *, sum(CASE WHEN top IS NULL OR s > top THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, day ORDER BY s, e ROWS UNBOUNDED PRECEDING) k FROM m), u AS (SELECT user_id, day, min(s) s, max(e) e FROM g GROUP BY user_id, day, k),
 x AS (SELECT user_id, day, coalesce(lag(e) OVER (PARTITION BY user_id, day ORDER BY s), day + INTERVAL 8 HOUR) slot_start, s slot_end FROM u UNION ALL SELECT user_id, day, max(e), day + INTERVAL 18 HOUR FROM u GROUP BY user_id, day),
 slots AS (SELECT *, floor((epoch(slot_end) - epoch(slot_start)) / 60 + 0.5)::bigint AS minutes FROM x WHERE slot_end > slot_start AND floor((epoch(slot_end) - epoch(slot_start)) / 60 + 0.5) >= 30)"""


@query("w06_free_slots", _SLOTS + " SELECT user_id, day, slot_start, slot_end, minutes FROM slots")
def _(t):
    e = t.events.select("user_id", F.to_date("ts").alias("day"), "ts", (c("ts") + F.expr("interval 30 minutes")).alias("until"))
    d = c("day").cast("timestamp_ntz")
    return N.free_slots(e, ["user_id", "day"], "ts", "until", d + F.expr("interval 8 hours"), d + F.expr("interval 18 hours"))


@query("w07_first_fit", _SLOTS + " SELECT user_id, day, slot_start, slot_end, minutes FROM (SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY hour(slot_start) < 12, slot_start) r FROM slots) WHERE r = 1")
def _(t):
    e = t.events.select("user_id", F.to_date("ts").alias("day"), "ts", (c("ts") + F.expr("interval 30 minutes")).alias("until"))
    d = c("day").cast("timestamp_ntz")
    s = N.free_slots(e, ["user_id", "day"], "ts", "until", d + F.expr("interval 8 hours"), d + F.expr("interval 18 hours"))
    return N.first_fit(s, ["user_id", "day"], F.hour("slot_start") >= 12)


@query("w09_carried", "SELECT event_id, last_value(CASE WHEN value > 50 THEN event_type END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) speaker FROM events")
def _(t):
    e = t.events.withColumn("label", F.when(c("value") > 50, c("event_type")))
    return N.carried(e, ["user_id"], ["ts", "event_id"], "label", "speaker").select("event_id", "speaker")


@query("w10_context", "SELECT event_id, concat_ws(' ', nullif(trim(lag(event_type) OVER w), ''), nullif(trim(event_type), ''), nullif(trim(lead(event_type) OVER w), '')) context FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def _(t):
    return N.with_context(t.events, ["user_id"], ["ts", "event_id"], "event_type", "context").select("event_id", "context")


@query("w11_length_batches", "SELECT row_id, ((row_number() OVER (ORDER BY length(coalesce(response, '')), row_id) - 1) // 16)::bigint batch FROM train_smoke")
def _(t):
    return N.length_batches(t.train_smoke.select("row_id", F.length(F.coalesce("response", F.lit(""))).alias("n")), "n", "row_id").select("row_id", "batch")


@query("a25_padded_positions", "SELECT sum(p)::bigint padded, sum(t)::bigint tokens FROM (SELECT count(*) * max(n) p, sum(n) t FROM (SELECT length(coalesce(response, '')) n, (row_number() OVER (ORDER BY length(coalesce(response, '')), row_id) - 1) // 16 b FROM train_smoke) GROUP BY b)")
def _(t):
    b = N.length_batches(t.train_smoke.select("row_id", F.length(F.coalesce("response", F.lit(""))).alias("n")), "n", "row_id")
    return N.padded_positions(b, "batch", "n")


@query("w12_greedy_share")
def _(t):
    d = t.train_smoke.where("response is not null and src is not null").select("row_id", F.lower(F.trim("src")).alias("s"), X.prose_tokens(c("response")).alias("tokens"), F.lit(5000).alias("budget"))
    return N.greedy_share(d, ["s"], "tokens", "budget", ["row_id"]).select("row_id", "s", "tokens")


@query("w13_trimmed_turns", "SELECT key, CASE WHEN len(fit) > 0 THEN n - fit[1] END n_kept FROM (SELECT key, n, list_filter(range(0, n + 1, 2), lambda k: n - k >= least(n, 4) AND coalesce(list_sum(t[1:n - k]), 0) <= 400) fit FROM (SELECT key, len(messages) n, list_transform(messages, lambda m: coalesce(ceil(strlen(m.content) / 3.2), 0)) t FROM oasst_v8))")
def _(t):
    tokens = F.transform("messages", lambda m: F.coalesce(X.prose_tokens(m.content), F.lit(0)))
    return t.oasst_v8.select("key", N.trimmed_turns(c("messages"), tokens, 400).alias("kept")).select("key", F.when(c("kept").isNotNull(), F.size("kept")).alias("n_kept"))


@query("w14_prefix_within", "SELECT event_id FROM (SELECT event_id, sum(user_id % 9 + 2) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) run FROM events) WHERE run <= 60")
def _(t):
    return N.prefix_within(t.events.withColumn("tok", c("user_id") % 9), ["user_id"], ["ts", "event_id"], "tok", 60).select("event_id")


@query("w15_newest", "SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) r FROM events) WHERE r <= 3")
def _(t):
    return N.newest(t.events, ["user_id"], "event_id", 3).select("event_id")


@query("w16_oldest", "SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) r FROM events WHERE event_type <> 'click') WHERE r <= 2")
def _(t):
    return N.oldest(t.events, ["user_id"], "event_id", 2, c("event_type") == "click").select("event_id")


@query("w17_eviction", "SELECT user_id, sum(event_id % 500)::bigint tokens, 32768 - 900 - 2000 - 2000 - 768 - sum(event_id % 500)::bigint left_over, (32768 - 900 - 2000 - 2000 - 768 - sum(event_id % 500)) < 5000 tight, greatest(0, count(*) FILTER (event_type <> 'system') - 10) evictable FROM events GROUP BY user_id")
def _(t):
    return N.eviction(t.events.select("user_id", "event_id", c("event_type").alias("role"), (c("event_id") % 500).alias("tokens")), "user_id", "event_id", "tokens")


@query("w18_compressed_history", "SELECT event_id, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) > 4 THEN left(props, 5) || '...' ELSE props END view FROM events")
def _(t):
    return N.compressed_history(t.events, ["user_id"], "event_id", "props", 4, F.concat(F.left("props", F.lit(5)), F.lit("..."))).select("event_id", "view")


@query("w19_rolling_band", "SELECT event_id, round(avg(value) OVER w, 5) AS mean, round(coalesce(stddev_samp(value) OVER w, 0), 4) deviation FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)")
def _(t):
    return N.rolling_band(t.events, ["user_id"], ["ts", "event_id"], "value").select("event_id", F.round("mean", 5).alias("mean"), F.round("deviation", 4).alias("deviation"))


@query("w20_variants", "SELECT event_id, ((row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) % 5)::bigint variant FROM events")
def _(t):
    return N.variants(t.events, ["user_id"], ["event_id"], 5).select("event_id", "variant")


@query("w21_loops")
def _(t):
    return t.train_smoke.select("row_id", U.ends_in_loop("response").alias("loops"))


@query("w22_chunks")
def _(t):
    return t.documents.select("doc_id", F.posexplode(U.chunks(500)("text")).alias("chunk_index", "content"))


# ---- sampling


def _chance(seed: int, key: str) -> str:
    return f"sha1('{seed}|' || {key})"


@query("l01_sample_per_source", f"SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY {_chance(3407, 'doc_id')}) r FROM documents WHERE n_chars >= 300) WHERE r <= 20")
def _(t):
    return L.sample_each(t.documents.where("n_chars >= 300"), ["source"], c("doc_id"), 3407, 20).select("doc_id")


_quota = {"forum_mix": 30, "wiki_en": 500, "notices": 5}


@query("l02_quotas", f"SELECT doc_id FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY {_chance(11, 'doc_id')}, doc_id) r FROM documents) WHERE r <= CASE source WHEN 'forum_mix' THEN 30 WHEN 'wiki_en' THEN 500 WHEN 'notices' THEN 5 END")
def _(t):
    return L.quotas(t.documents, "source", _quota, c("doc_id"), 11).select("doc_id")


@query("l02_shortage", "SELECT q.source, q.n::int quota, least(q.n, coalesce(d.n, 0))::bigint taken, (q.n - least(q.n, coalesce(d.n, 0)))::bigint short FROM (VALUES ('forum_mix', 30), ('wiki_en', 500), ('notices', 5)) q(source, n) LEFT JOIN (SELECT source, count(*) n FROM documents GROUP BY 1) d USING (source)")
def _(t):
    return L.shortage(L.quotas(t.documents, "source", _quota, c("doc_id"), 11), "source", _quota)


@query("l06_stratified", f"SELECT doc_id, CASE WHEN row_number() OVER (PARTITION BY source ORDER BY {_chance(42, 'doc_id')}, doc_id) <= round_even(count(*) OVER (PARTITION BY source) * 0.8, 0) THEN 'train' ELSE 'test' END split FROM documents")
def _(t):
    return L.stratified(t.documents, "source", c("doc_id"), 0.8, 42).select("doc_id", "split")


@query("l08_exact_strata", f"""WITH n AS (SELECT source, count(*) n, sum(count(*)) OVER () whole FROM documents GROUP BY 1), w AS (SELECT *, whole - ceil(whole * 0.05)::bigint train FROM n), f AS (SELECT *, (n * train) // whole low, (n * train) % whole rest, train - sum((n * train) // whole) OVER () more FROM w),
 q AS (SELECT source, low + (row_number() OVER (ORDER BY rest DESC, source) <= more)::int take FROM f) SELECT doc_id, CASE WHEN r <= take THEN 'train' ELSE 'test' END split FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY {_chance(7, 'doc_id')}, doc_id) r FROM documents) JOIN q ON documents_source(source, q.source)""".replace("ON documents_source(source, q.source)", "USING (source)"))
def _(t):
    return L.stratified_exact(t.documents, "source", c("doc_id"), 0.05, 7).select("doc_id", "split")


@query("l07_three_way", f"SELECT p_partkey, CASE WHEN n = 1 THEN 'train' WHEN n = 2 THEN CASE WHEN r = 1 THEN 'test' ELSE 'train' END WHEN r <= greatest(1, floor(n * 0.1)) THEN 'eval' WHEN r <= 2 * greatest(1, floor(n * 0.1)) THEN 'test' ELSE 'train' END split FROM (SELECT p_partkey, count(*) OVER (PARTITION BY p_brand) n, row_number() OVER (PARTITION BY p_brand ORDER BY {_chance(42, 'p_partkey')}, p_partkey) r FROM part)")
def _(t):
    return L.three_way(t.part, "p_brand", c("p_partkey"), 42).select("p_partkey", "split")


_u = "(('0x' || left(sha1({}::varchar), 8))::bigint / 4294967296.0)"


@query("l09_uniform_split", f"SELECT o_orderkey, CASE WHEN {_u.format('o_orderkey')} < 0.02 THEN 'test' ELSE 'train' END split FROM orders")
def _(t):
    return L.uniform_split(t.orders, c("o_orderkey"), 0.02).select("o_orderkey", "split")


@query("l10_time_split", "SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN 'train' ELSE 'test' END split FROM orders")
def _(t):
    return L.time_split(t.orders, "o_orderdate", F.expr("timestamp_ntz '1997-01-01'")).select("o_orderkey", "split")


@query("l11_weighted_choice", f"SELECT pool_id, CASE WHEN {_u.format('key')} < 0.30 THEN 'short' WHEN {_u.format('key')} < 0.75 THEN 'medium' ELSE 'long' END budget FROM pool_todo WHERE key IS NOT NULL")
def _(t):
    return t.pool_todo.where("key is not null").select("pool_id", L.weighted_choice(c("key"), list(W.BUDGETS), W.BUDGET_WEIGHTS["topical"]).alias("budget"))


@query("l12_first_k", "SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) r FROM orders) WHERE r <= 2")
def _(t):
    return L.first_k(t.orders, ["o_custkey"], [c("o_orderdate"), c("o_orderkey")], 2).select("o_orderkey")


@query("l13_reinforced", "SELECT n_nationkey FROM nation, range(3) WHERE n_nationkey < 2 UNION ALL SELECT n_nationkey FROM nation WHERE n_nationkey >= 2")
def _(t):
    return L.reinforced(t.nation.select("n_nationkey"), F.when(c("n_nationkey") < 2, 3).otherwise(1))


@query("l14_top_prices", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def _(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(c("o_totalprice").desc(), "o_orderkey").limit(25)


@query("l15_nulls_last", "SELECT pool_id, category FROM pool_todo ORDER BY category ASC NULLS LAST, pool_id LIMIT 50")
def _(t):
    return t.pool_todo.select("pool_id", "category").orderBy(c("category").asc_nulls_last(), "pool_id").limit(50)


@query("l16_ordered", "SELECT key, turns FROM oasst_v8 ORDER BY turns, key")
def _(t):
    return t.oasst_v8.select("key", "turns").orderBy("turns", "key")


@query("l17_newest_first", "SELECT doc_id, loaded_at FROM documents ORDER BY loaded_at DESC NULLS LAST, doc_id LIMIT 20")
def _(t):
    return t.documents.select("doc_id", "loaded_at").orderBy(c("loaded_at").desc_nulls_last(), "doc_id").limit(20)


@query("l18_demote_and_cap", f"WITH d AS (SELECT row_id, coalesce(regexp_matches(response, '[{S.DEV}]') AND NOT regexp_matches(instruction, '[{S.DEV}]'), false) demoted, lower(trim(src)) = 'hindi' anchor FROM train_smoke) SELECT row_id FROM d WHERE NOT demoted UNION ALL SELECT row_id FROM (SELECT row_id, row_number() OVER (ORDER BY {_chance(7, 'row_id')}, row_id) r FROM d WHERE demoted) WHERE r <= (SELECT floor(count(*) FILTER (anchor) * 0.12) FROM d)")
def _(t):
    dev = f"[{X.DEVANAGARI}]"
    d = c("response").rlike(dev) & ~c("instruction").rlike(dev)
    return L.demote_and_cap(t.train_smoke.select("row_id", "src", "instruction", "response"), d, F.lower(F.trim("src")) == "hindi", 0.12, c("row_id"), 7).select("row_id")


# ---- sets


@query("e01_union", "SELECT 'pairs' AS src, count(*) n FROM train_smoke UNION ALL SELECT 'teacher', count(*) FROM teacher_gen")
def _(t):
    u = Z.union_tagged({"pairs": t.train_smoke.select("instruction", "response", "row_id"), "teacher": t.teacher_gen.select("instruction", "response", "judge")})
    return u.groupBy("src").agg(F.count("*").alias("n"))


@query("e02_missing", "SELECT DISTINCT key FROM train_smoke t WHERE NOT EXISTS (SELECT 1 FROM pool_todo p WHERE p.key = t.key)")
def _(t):
    return Z.missing_from(t.train_smoke, t.pool_todo, "key")


@query("e03_overlap", f"SELECT row_id, round(coalesce(len(list_intersect(a, b)) / nullif(len(a), 0)::double, 0), 6) overlap FROM (SELECT row_id, list_distinct(list_transform(regexp_extract_all(coalesce(instruction, ''), '[{S.DEV}]{{3,}}|[a-zA-Z]{{4,}}'), lambda x: lower(x))) a, list_distinct(list_transform(regexp_extract_all(coalesce(response, ''), '[{S.DEV}]{{3,}}|[a-zA-Z]{{4,}}'), lambda x: lower(x))) b FROM train_smoke)")
def _(t):
    i, r = F.coalesce("instruction", F.lit("")), F.coalesce("response", F.lit(""))
    return t.train_smoke.select("row_id", F.round(Z.overlap(X.content_words(i), X.content_words(r)), 6).alias("overlap"))


# ---- extraction


def _kinds(t: str) -> str:
    # The patterns in RE2, which has no look-around: ASCII word boundaries.
    pats = {
        "ssn": r"\b\d{3}-\d{2}-\d{4}\b", "credit_card": r"\b(?:\d[ -]*?){13,19}\b", "email": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", "phone": r"\b(?:\+?1[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}\b", "aws_key": "AKIA[0-9A-Z]{16}", "github_token": "gh[pousr]_[A-Za-z0-9_]{36,}",
        "stripe_key": "(?:sk|pk)_(?:test|live)_[0-9a-zA-Z]{24,}", "private_key": "-----BEGIN (?:RSA |EC |DSA )?PRIVATE KEY-----", "generic_api_key": r"(?i)(?:password|secret|token|api_key|apikey)\s*[:=]\s*['\"][^'\"]{8,}['\"]",
    }
    return " UNION ALL ".join(f"SELECT doc_id, line, '{k}' AS kind, unnest(regexp_extract_all(l, {S.q(p)})) m, l FROM {t}" for k, p in pats.items())


# Digits doubled at every second place from the end, nine off what is over nine, must sum to a multiple of ten.
_luhn = r"(length(d) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, length(d) + 1), lambda i: CASE WHEN (length(d) - i) % 2 = 1 THEN (2 * d[i]::int) - CASE WHEN d[i]::int > 4 THEN 9 ELSE 0 END ELSE d[i]::int END)) % 10 = 0)"
_found = r'''WITH t AS (SELECT {} doc_id, {} AS text FROM {}), s AS (SELECT doc_id, string_split_regex(text, '\r\n|[\n\r\x{{0B}}\x{{0C}}\x{{1C}}-\x{{1E}}\x{{85}}\x{{2028}}\x{{2029}}]') ls FROM t WHERE text IS NOT NULL), l AS (SELECT doc_id, unnest(range(1, len(ls) + 1))::int line, unnest(ls) l FROM s),
 f AS (SELECT doc_id, line, kind, m, l, regexp_replace(m, '\D', '', 'g') d FROM ({}) q), g AS (SELECT * FROM f WHERE kind <> 'credit_card' OR ''' + _luhn + r'''),
 found AS (SELECT doc_id, line, kind, CASE WHEN length(trim(m)) <= 4 THEN repeat('*', length(trim(m))) ELSE left(trim(m), 2) || repeat('*', length(trim(m)) - 4) || right(trim(m), 2) END masked, left({}, 200) context FROM g)'''


def _found_in(key: str, text: str, table: str) -> str:
    return _found.format(key, text, table, _kinds("l"), S.strip("l"))


_docs = ("doc_id", "text", "documents")
# A line of each kind of finding, with the customer's number: valid cards are few.
_planted = ("c_custkey", r"'ssn ' || (100 + c_custkey % 900) || '-12-3456, card 4111 1111 1111 ' || (1000 + c_custkey % 9000) || chr(10) || ' mail ' || lower(c_mktsegment) || '@ex.co (555) 123-4567 ' || chr(10) || 'AKIA' || lpad(c_custkey::varchar, 16, '0') || ' sk_live_' || repeat('a', 24) || ' ghs_' || repeat('b', 36) || ' -----BEGIN RSA PRIVATE KEY-----' || chr(10) || 'password = ''hunter-' || c_custkey || '-2'''", "customer")


def _sensitive(t):
    k = c("c_custkey")
    lines = F.concat(
        F.lit("ssn "), (100 + k % 900).cast("string"), F.lit("-12-3456, card 4111 1111 1111 "), (1000 + k % 9000).cast("string"), F.lit("\n mail "), F.lower("c_mktsegment"), F.lit("@ex.co (555) 123-4567 \nAKIA"), F.lpad(k.cast("string"), 16, "0"), F.lit(" sk_live_" + "a" * 24 + " ghs_" + "b" * 36),
        F.lit(" -----BEGIN RSA PRIVATE KEY-----\npassword = 'hunter-"), k.cast("string"), F.lit("-2'"),
    )
    return t.customer.select(k.alias("doc_id"), lines.alias("text"))


@query("x01_findings", _found_in(*_docs) + " SELECT doc_id, line, kind, masked, context FROM found")
def _(t):
    return E.findings(t.documents.select("doc_id", "text"), "doc_id", "text", {**W.PII, **W.SECRETS}, first=W.SENSITIVE)


@query("gate34_sensitive", _found_in(*_planted) + " SELECT doc_id, line, kind, masked, context FROM found")
def _(t):
    return E.findings(_sensitive(t), "doc_id", "text", {**W.PII, **W.SECRETS}, first=W.SENSITIVE)


@query("x02_redacted", r"SELECT c_custkey, 'my [REDACTED-accountNumber], mail [REDACTED-email], ssn [REDACTED-ssn], card [REDACTED-creditCard], call ([REDACTED-phone] or 12' AS said FROM customer")
def _(t):
    k = F.lpad(c("c_custkey").cast("string"), 10, "7")
    s = F.concat(F.lit("my account number is "), k, F.lit(", mail A.b@"), F.lower("c_mktsegment"), F.lit(".Co, ssn 123-45-6789, card 4111 1111 1111 1112, call (555) 123-4567 or 12"))
    return t.customer.select("c_custkey", U.redacted(s).alias("said"))


@query("x03_cleanup", _found_in(*_planted) + """ SELECT doc_id, kind, count(*) matches, min(line) first_line, CASE WHEN kind IN ('ssn', 'credit_card', 'email', 'phone') THEN 'redact' WHEN kind = 'private_key' THEN 'move' ELSE 'rotate' END AS action,
 CASE WHEN kind IN ('email', 'phone') THEN 'low' WHEN kind = 'generic_api_key' THEN 'medium' ELSE 'high' END severity FROM found GROUP BY doc_id, kind""")
def _(t):
    return E.cleanup_actions(E.findings(_sensitive(t), "doc_id", "text", {**W.PII, **W.SECRETS}, first=W.SENSITIVE), "doc_id")


def _meeting(t):
    k = c("p_partkey").cast("string")
    return t.part.select("p_partkey", F.concat(F.lit("Ann: Hello. We decided to buy "), c("p_brand"), F.lit(".\n\nBob: TODO: @Eve ship item "), k, F.lit(" by Friday. urgent\n\n\nThey should check "), c("p_type"), F.lit(" eventually\nAnn: I will call them before noon. Why not?\nWhy not?")).alias("s"))


@query("x04_action_items", '''SELECT p_partkey, unnest([1, 3, 6, 7, 7, 8])::int line, unnest(['decision', 'action', 'action', 'commitment', 'question', 'question']) kind, unnest(['Ann', 'Eve', 'Bob', 'Ann', NULL, NULL]) who,
 unnest(['to buy ' || p_brand, '@Eve ship item ' || p_partkey || ' by Friday. urgent', 'They should check ' || p_type || ' eventually', 'call them before noon', 'I will call them before noon. Why not?', 'Why not?']) content,
 unnest([NULL, 'Friday', '', 'noon', NULL, NULL]) deadline, unnest([NULL, 'high', 'low', NULL, NULL, NULL]) priority FROM part''')
def _(t):
    return E.meeting_items(_meeting(t), "p_partkey", "s").drop("context")


@query("x05_minutes", '''SELECT p_partkey, concat_ws(chr(10), '## Meeting Minutes' || chr(10), '### Attendees' || chr(10), '- Ann', '- Bob', '', '### Discussion' || chr(10), '**Topic 1**' || chr(10), 'Ann: Hello. We decided to buy ' || p_brand || '.', '', '**Topic 2**' || chr(10), 'Bob: TODO: @Eve ship item ' || p_partkey || ' by Friday. urgent', '',
 '**Topic 3**' || chr(10), 'They should check ' || p_type || ' eventually' || chr(10) || 'Ann: I will call them before noon. Why not?' || chr(10) || 'Why not?', '', '### Action Items' || chr(10), '- **Eve**: @Eve ship item ' || p_partkey || ' by Friday. urgent (due: Friday) [high]', '- **Bob**: They should check ' || p_type || ' eventually [low]', '',
 '### Decisions' || chr(10), '- to buy ' || p_brand || ' (Ann)', '', '### Open Questions' || chr(10), '- I will call them before noon. Why not?', '- Why not?', '') AS minutes FROM part''')
def _(t):
    return E.minutes(_meeting(t), "p_partkey", "s")


@query("x06_fields", r"SELECT doc_id, nullif(regexp_extract(text, '([\w.+-]+@[\w-]+\.[\w.]*\w)', 1), '') email, nullif(regexp_extract(text, '(\d+)', 1), '') number FROM documents WHERE text IS NOT NULL")
def _(t):
    return t.documents.where("text is not null").select("doc_id", E.extract_field(c("text"), "email")["value"].alias("email"), E.extract_field(c("text"), "number")["value"].alias("number"))


@query("x07_tables", "SELECT n_nationkey, 'a,b' cells FROM nation UNION ALL SELECT n_nationkey, trim(n_name) || ',' || n_nationkey FROM nation")
def _(t):
    s = F.concat(F.lit("a|b\n"), c("n_name"), F.lit("|"), c("n_nationkey").cast("string"))
    return t.nation.select("n_nationkey", F.explode(U.table_rows(s)).alias("cells")).select("n_nationkey", F.array_join("cells", ",").alias("cells"))


@query("x08_suggestions", """SELECT p_partkey, unnest(['Draft reply email', 'Open URL', 'Open file', 'Create task', 'Create calendar event', 'Extract to spreadsheet']) AS action, unnest([0.85, 0.85, 0.8, 0.8, 0.75, 0.63]::double[]) confidence, unnest(range(0, 6))::int AS rank FROM part WHERE p_partkey % 2 = 0
 UNION ALL SELECT p_partkey, 'Extract to spreadsheet', 0.63::double, 0 FROM part WHERE p_partkey % 2 = 1""")
def _(t):
    s = F.when(c("p_partkey") % 2 == 0, F.concat(F.lit("a.b@c.de see https://x.y/z TODO /usr/"), F.regexp_replace("p_brand", "#", ""), F.lit(" at 12:30"))).otherwise(c("p_name"))
    return E.suggestions(t.part.select("p_partkey", s.alias("s")), "p_partkey", "s", elements=F.array(F.lit("p|q|r"))).withColumn("confidence", F.round("confidence", 6))


@query("x09_tool_calls", '''SELECT event_id, CASE event_id % 7 WHEN 0 THEN '{"arguments": {"level": "' || event_type || '", "n": ' || user_id || '}, "name": "set_mode"}' WHEN 1 THEN '{"arguments": {"k": ' || user_id || '}, "name": "a.b"}' WHEN 2 THEN '{"arguments": {"t": "' || event_type || '"}, "name": "x.y"}'
 WHEN 3 THEN '{"arguments": {"on": true, "s": "a, b"}, "name": "f"}' WHEN 4 THEN '{"arguments": {}, "name": "files.list_dir"}' WHEN 5 THEN '{"arguments": {"v": ' || user_id || '}, "name": "g"}' END AS call FROM events''')
def _(t):
    k = c("user_id").cast("string")
    forms = (
        F.concat(F.lit("<think>[no(a=1)]</think>[set_mode(level='"), "event_type", F.lit("', n="), k, F.lit(")]")), F.concat(F.lit("ok\nTool: a.b\nArguments: {\"k\": "), k, F.lit(",}")), F.concat(F.lit("<|tool_call_start|>[x.y(t=\""), "event_type", F.lit("\")]<|tool_call_end|> done")),
        F.lit("[f(on=True, s='a, b')]"), F.lit("see `report.txt`, then `files.list_dir` and `a.b`"), F.concat(F.lit("```json\n{\"name\": \"g\", \"arguments\": {\"v\": "), k, F.lit("}}\n```")), F.concat(F.lit("no call in "), "event_type"),
    )
    return t.events.select("event_id", U.tool_call(F.element_at(F.array(*forms), (c("event_id") % 7 + 1).cast("int"))).alias("call"))


@query("x11_calls_text", "SELECT event_id, '[' || event_type || '(' || props || ')]' calls FROM events")
def _(t):
    return t.events.select("event_id", E.calls_text(F.array(F.struct(c("event_type").alias("name"), c("props").alias("arguments")))).alias("calls"))


@query("x12_json", "SELECT event_id, props ->> '$.k' k FROM events")
def _(t):
    return t.events.select("event_id", E.json_field(c("props"), "$.k").alias("k"))


@query("x14_tags", "SELECT event_id, CASE WHEN event_type = 'click' THEN 'click' WHEN event_type = 'view' THEN 'view' ELSE 'none' END tag FROM events")
def _(t):
    return t.events.select("event_id", E.tagged(F.concat(F.lit("["), c("event_type"), F.lit("] x")), ("click", "view")).alias("tag"))


@query("x15_diffs", "SELECT p_partkey, 'insert' AS op, '' a, p_type b FROM part WHERE p_size >= 25 UNION ALL SELECT p_partkey, 'replace', p_brand, p_type FROM part WHERE p_size < 25")
def _(t):
    """A line put in, or another in its place."""
    a = F.concat_ws("\n", "p_name", F.when(c("p_size") < 25, c("p_brand")), F.lit("end"))
    d = U.line_diff(a, F.concat_ws("\n", "p_name", "p_type", F.lit("end")))
    return t.part.select("p_partkey", F.explode(d).alias("d")).select("p_partkey", "d.op", "d.a", "d.b")


@query("x16_how_to", "SELECT p_partkey, 'How to ' || lower(p_name) || '?' question, concat_ws(chr(10), nullif(trim(p_brand), ''), '1. ' || p_type || chr(10) || '2. ' || p_name) answer FROM part")
def _(t):
    return E.how_to(t.part, "p_partkey", c("p_name"), c("p_brand"), F.array("p_type", "p_name"))


@query("x17_context", "SELECT pool_id, CASE WHEN trim(coalesce(category, '')) <> '' THEN instruction || chr(10) || chr(10) || trim(category) ELSE instruction END prompt FROM pool_todo")
def _(t):
    return t.pool_todo.select("pool_id", E.merged_context(c("instruction"), c("category")).alias("prompt"))


@query("x18_times", "SELECT event_id, CASE event_id % 3 WHEN 0 THEN ts + INTERVAL 3 HOUR WHEN 1 THEN date_trunc('day', ts) + INTERVAL 32 HOUR ELSE CASE WHEN date_trunc('day', ts) + INTERVAL 21 HOUR > ts THEN date_trunc('day', ts) + INTERVAL 21 HOUR ELSE date_trunc('day', ts) + INTERVAL 45 HOUR END END AS ends FROM events")
def _(t):
    s = F.element_at(F.array(F.lit("for 3 hours"), F.lit("until tomorrow"), F.lit("tonight")), (c("event_id") % 3 + 1).cast("int"))
    return t.events.select("event_id", E.time_expression(s, c("ts")).alias("ends"))


@query("x19_slots", """SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'restart' WHEN 1 THEN 'pause_internet' WHEN 2 THEN 'upgrade' END AS action, CASE event_id % 4 WHEN 0 THEN 'tomorrow morning' WHEN 1 THEN 'until specific time' WHEN 2 THEN 'for a few hours' ELSE 'tonight' END AS time,
 CASE event_id % 4 WHEN 0 THEN 'upstairs' WHEN 3 THEN 'living room' END place, CASE event_id % 4 WHEN 2 THEN 'error 502' WHEN 3 THEN 'blinking red' END error, CASE event_id % 4 WHEN 0 THEN 'high' WHEN 2 THEN 'medium' ELSE 'low' END urgency, CASE event_id % 4 WHEN 0 THEN 'hub' END device FROM events""")
def _(t):
    said = ("Power cycle the hub upstairs tomorrow morning, ASAP", "pause  internet until 9:30 pm", "Upgrade for 3 hours: ERROR 502, it is slow", "a blinking red and blinking white light in the living room tonight")
    s = F.element_at(F.array(*map(F.lit, said)), (c("event_id") % 4 + 1).cast("int"))
    return t.events.select("event_id", E.request_slots(s, {"hub": r"\bhub\b"}).alias("x")).select("event_id", "x.*")


# ---- retrieval

_cos = "round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 6)"


@query("r01_hash_embeddings")
def _(t):
    return t.part.select("p_partkey", F.transform(X.hash_embedding(c("p_name")), lambda x: F.round(x, 6)).alias("embedding"))


@query("r02_cosine", f"SELECT a.vec_id, {_cos} score FROM embeddings a, (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) b")
def _(t):
    one = t.embeddings.orderBy("vec_id").limit(1).select(c("embedding").alias("q"))
    return t.embeddings.join(F.broadcast(one), F.lit(True)).select("vec_id", F.round(R.cosine(c("embedding"), c("q")), 6).alias("score"))


@query("r03_top_k", f"SELECT a.vec_id, {_cos} score FROM embeddings a, (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) b ORDER BY score DESC, vec_id LIMIT 10")
def _(t):
    q = (t.embeddings.orderBy("vec_id").select("embedding").first() or [None])[0]
    return R.top_k(t.embeddings, "vec_id", "embedding", q, 10)


@query("r04_top_k_each", f"SELECT query, vec_id, score, rank::int rank FROM (SELECT b.vec_id query, a.vec_id, {_cos} score, row_number() OVER (PARTITION BY b.vec_id ORDER BY {_cos} DESC, a.vec_id) rank FROM embeddings a, embeddings b WHERE b.vec_id % 50 = 0 AND a.vec_id <> b.vec_id) WHERE rank <= 5")
def _(t):
    return R.top_k_each(t.embeddings.select("vec_id", "embedding"), "vec_id", "embedding", t.embeddings.where("vec_id % 50 = 0"), 5)


@query("r05_mean_pooled", "SELECT vec_id, 1.0 length, round((m[1]) / sqrt(list_inner_product(m, m)), 5) x0 FROM (SELECT vec_id, list_transform(range(1, len(v) + 1), lambda i: (v[i] + v[len(v) + 1 - i]) / 2) m FROM (SELECT vec_id, embedding::double[] v FROM embeddings))")
def _(t):
    p = R.mean_pooled(F.array(c("embedding"), F.reverse("embedding")))
    return t.embeddings.select("vec_id", F.round(R.norm(p), 5).alias("length"), F.round(p[0], 5).alias("x0"))


def _bm25(fields: dict[str, int], query: str) -> str:
    text = " || ".join(f"list_transform(range(0, {n}), lambda i: coalesce({f}, ''))" for f, n in fields.items())
    return f"""d AS (SELECT pool_id, {S.terms(f"array_to_string({text}, ' ~ ')")} ts FROM pool_todo), q AS (SELECT unnest({S.terms(S.q(query))}) q), st AS (SELECT count(*) n, avg(len(ts)) mean FROM d), df AS (SELECT q, (SELECT count(*) FROM d WHERE list_contains(ts, q)) df FROM (SELECT DISTINCT q FROM q)),
 bm AS (SELECT pool_id, sum(ln((n - df + 0.5) / (df + 0.5) + 1) * f * 2.5 / (f + 1.5 * (0.25 + 0.75 * len(ts) / greatest(mean, 1e-9)))) score FROM (SELECT d.pool_id, d.ts, df.df, st.n, st.mean, len(list_filter(d.ts, lambda x: x = q.q)) f FROM d, q JOIN df USING (q), st) WHERE f > 0 GROUP BY pool_id)"""


@query("r06_bm25", "WITH " + _bm25({"instruction": 3, "category": 1}, "tips for keeping the night bus clean") + " SELECT pool_id, round(score, 6) score FROM bm")
def _(t):
    return R.bm25(t.pool_todo, "pool_id", {"instruction": 3, "category": 1}, "tips for keeping the night bus clean", W.STOPWORDS).select("pool_id", F.round("score", 6).alias("score"))


_phrase = "(SELECT pool_id, len(list_distinct(q)) nq, len(list_distinct(p)) np, len(list_intersect(q, p)) k FROM (SELECT pool_id, {} q, {} p FROM pool_todo))".format(S.terms("'keeping the night bus clean'"), S.terms("coalesce(instruction, '')"))


@query("r07_phrases", f"SELECT pool_id, round((CASE WHEN np > 0 THEN k / np ELSE 0 END + k / nq) / 2 + CASE WHEN np > 0 AND k = np THEN 0.05 ELSE 0 END, 6) score FROM {_phrase}")
def _(t):
    q, p = X.search_terms(F.lit("keeping the night bus clean"), W.STOPWORDS), X.search_terms(F.coalesce("instruction", F.lit("")), W.STOPWORDS)
    return t.pool_todo.select("pool_id", F.round(R.phrase_score(q, p), 6).alias("score"))


@query("r08_with_priors", "WITH " + _bm25({"instruction": 3}, "night bus") + ", best AS (SELECT pool_id, score FROM bm ORDER BY round(score, 9) DESC, pool_id LIMIT 16) SELECT pool_id, round(score + CASE WHEN category IS NOT NULL THEN 1.5 ELSE 0 END + CASE WHEN src = 'arena' THEN 0.6 ELSE 0 END, 6) total FROM best JOIN pool_todo USING (pool_id) ORDER BY 2 DESC, pool_id LIMIT 3")
def _(t):
    s = R.bm25(t.pool_todo, "pool_id", {"instruction": 3}, "night bus", W.STOPWORDS).withColumn("score", F.round("score", 9)).join(t.pool_todo.select("pool_id", "category", "src"), "pool_id")
    return R.with_priors(s, "pool_id", {"category": (c("category").isNotNull(), 1.5), "source": (c("src") == "arena", 0.6)}).select("pool_id", F.round("total", 6).alias("total"))


@query("r09_max_sim", "SELECT vec_id, round(greatest(list_inner_product(v, v), list_inner_product(v, list_reverse(v))), 5) score FROM (SELECT vec_id, embedding::double[] v FROM embeddings)")
def _(t):
    v = c("embedding")
    return t.embeddings.select("vec_id", F.round(R.max_sim(F.array(v), F.array(v, F.reverse(v))), 5).alias("score"))


@query("r10_keywords", "SELECT n_nationkey, 3.0::double score, 0.555556::double confidence FROM nation WHERE n_name = 'NATION_3'")
def _(t):
    """A phrase counts twice; another nation that is named once lies behind."""
    k = F.array(F.lower("n_name"), F.concat(F.lit("from "), F.lower("n_name")))
    got = R.keyword_match(t.nation.select("n_nationkey", k.alias("k")), "n_nationkey", "k", "A parcel from nation_3 to NATION_7")
    return got.select("n_nationkey", "score", F.round("confidence", 6).alias("confidence"))


@query("r11_threshold", f"SELECT a.vec_id, {_cos} score FROM embeddings a, (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) b WHERE {_cos} >= 0.2 ORDER BY score DESC, vec_id LIMIT 50")
def _(t):
    q = (t.embeddings.orderBy("vec_id").select("embedding").first() or [None])[0]
    return R.top_k(t.embeddings, "vec_id", "embedding", q, 50, 0.2)


def _pairs_of(t: str) -> str:
    """Distinct pairs of neighbouring words of which not both are stop words."""
    w = rf"list_filter(regexp_split_to_array(regexp_replace(lower({t}), '[^a-z0-9\s]', ' ', 'g'), '\s+'), lambda x: x <> '')"
    return f"(SELECT list_distinct(list_transform(list_filter(range(1, len(w)), lambda i: NOT (w[i] IN {S.STOP} AND w[i + 1] IN {S.STOP})), lambda i: w[i] || ' ' || w[i + 1])) FROM (SELECT {w} w))"


@query("r12_faithfulness", f"SELECT row_id, CASE WHEN instruction IS NULL THEN true WHEN len(a) = 0 OR len(b) = 0 THEN false ELSE len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) >= 0.1 END faithful FROM (SELECT row_id, instruction, {_pairs_of("coalesce(response, '')")} a, {_pairs_of('instruction')} b FROM train_smoke)")
def _(t):
    return t.train_smoke.select("row_id", R.faithfulness(F.coalesce("response", F.lit("")), c("instruction"), W.STOPWORDS).alias("faithful"))


# ---- sources


@query("s10_read_only_sql", "SELECT o_orderpriority, count(*) n FROM orders WHERE o_totalprice > 1000 GROUP BY 1")
def _(t):
    t.orders.createOrReplaceTempView("s10_orders")
    return io.read_only_sql(t.spark, "SELECT o_orderpriority, count(*) n FROM s10_orders WHERE o_totalprice > 1000 GROUP BY 1")


@query("s07_columns", "SELECT doc_id, source FROM documents")
def _(t):
    return io.read_columns(t.spark, f"{t.folder}/documents.parquet", ["doc_id", "source"])


@query("s19_names", "SELECT p_partkey FROM part WHERE regexp_matches(p_name, '(?i)red.*t')")
def _(t):
    return t.part.where(io.name_matches(c("p_name"), "RED*T")).select("p_partkey")


@query("s23_upsert", "SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN upper(n_name) || '!' ELSE n_name END n_name FROM nation WHERE n_nationkey <> 4")
def _(t):
    cur = t.nation.select("n_nationkey", "n_name", F.lit(1).alias("v"))
    new = t.nation.where("n_nationkey % 2 = 0").select("n_nationkey", F.concat(F.upper("n_name"), F.lit("!")).alias("n_name"), F.lit(2).alias("v"), (c("n_nationkey") == 4).alias("deleted"))
    return io.upsert(cur, new, "n_nationkey", "v").select("n_nationkey", "n_name")


# ---- streams, as batches


@query("t07_recent", "SELECT event_id, ts FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 6 HOUR")
def _(t):
    now = t.events.agg(F.max("ts").alias("now"))
    return streams.recent(t.events.join(F.broadcast(now), F.lit(True)), "ts", 6, c("now")).select("event_id", "ts")


@query("t09_session_log", "SELECT user_id, count(*) turns, sum(event_id % 50)::bigint tokens, sum(CASE WHEN r <= 10 THEN event_id % 50 ELSE 0 END)::bigint kept_tokens FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) r FROM events) GROUP BY user_id")
def _(t):
    return streams.session_log(t.events.select("user_id", "event_id", (c("event_id") % 50).alias("tokens")), "user_id", "event_id", "tokens")


@query("ext_tumbling_windows", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) n, round(sum(value), 4) total FROM events GROUP BY 1, 2")
def _(t):
    return streams.tumbling(t.events, "ts", "event_type").select(c("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("ext_sessions", "SELECT min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS end, user_id, count(*) n FROM (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) g FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END f FROM events)) GROUP BY user_id, g")
def _(t):
    return streams.sessions(t.events, "ts", "user_id").select(c("start").cast("timestamp_ntz").alias("start"), c("end").cast("timestamp_ntz").alias("end"), "user_id", "n")


# ---- star schema: joins and aggregates of the read-only SQL surface


@query("sql_pricing_summary", "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) sum_disc_price, round(avg(l_discount), 6) avg_disc, count(*) n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2")
def _(t):
    d = t.lineitem.where(c("l_shipdate") <= F.expr("timestamp_ntz '1998-09-02'"))
    return d.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(c("l_extendedprice") * (1 - c("l_discount"))), 2).alias("sum_disc_price"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n"))


@query("sql_region_revenue", "SELECT r_name, n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2")
def _(t):
    d = t.lineitem.join(t.orders, c("l_orderkey") == c("o_orderkey")).join(t.customer, c("o_custkey") == c("c_custkey")).join(t.nation, c("c_nationkey") == c("n_nationkey")).join(t.region, c("n_regionkey") == c("r_regionkey"))
    return d.groupBy("r_name", "n_name").agg(F.round(F.sum(c("l_extendedprice") * (1 - c("l_discount"))), 2).alias("revenue"))


# ---- the rest of the inventory


@query("f33_paragraphs", "SELECT p_partkey, concat_ws(chr(10) || chr(10), p_name, p_brand) body FROM part")
def _(t):
    return t.part.select("p_partkey", X.paragraphs(F.array("p_name", "p_brand")).alias("body"))


@query("f38_codes", "SELECT n_nationkey, CASE WHEN upper(trim(n_name)) IN ('FRANCE', 'AAA') THEN upper(trim(n_name)) WHEN contains(lower(n_name), 'an') THEN 'ANX' WHEN contains(lower(n_name), 'i') THEN 'IXX' ELSE upper(trim(n_name)) END code FROM nation")
def _(t):
    return t.nation.select("n_nationkey", X.code_of(c("n_name"), [("FRANCE", "zzz"), ("AAA", "zzzz"), ("ANX", "an"), ("IXX", "i")]).alias("code"))


@query("gate24_prompt_sizes", """SELECT key, (list_sum(list_transform(messages, lambda m: coalesce(length(m.content), 0))) <= 600 AND len(list_filter(messages, lambda m: contains(coalesce(m.content, ''), '"$ref"'))) = 0) fits FROM oasst_v8""")
def _(t):
    from corpusloom.operators.gates import prompt_fits

    return t.oasst_v8.select("key", prompt_fits(c("messages"), 600).alias("fits"))


@query("gate25_examples", "SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'roles' WHEN 1 THEN 'call' WHEN 2 THEN 'tool' END reason FROM events")
def _(t):
    """Two valid forms, and one without a system turn, without a call, and with an unknown tool."""
    from corpusloom.operators.gates import example_reason

    k = c("event_id") % 5
    call = F.when(k == 1, "done").when(k == 2, "[other(a=1)]").when(k == 3, F.concat(F.lit(" [set_mode(level='"), "event_type", F.lit("')] "))).otherwise("[get.mode()]")
    turn = lambda role, text: F.struct(role.alias("role"), text.alias("content"))
    m = F.array(turn(F.when(k == 0, "user").otherwise("system"), F.lit("s")), turn(F.lit("user"), F.lit("u")), turn(F.lit("assistant"), call))
    return t.events.select("event_id", example_reason(m, ["set_mode", "get.mode"]).alias("reason"))


@query("gate24_schemas", "SELECT p_partkey, p_partkey % 4 IN (0, 1) valid FROM part")
def _(t):
    k = (c("p_partkey") % 4 + 1).cast("int")
    s = F.element_at(F.array(F.lit('{"type": "object", "properties": {"a": {"type": "string"}}}'), F.lit('{"type": ["string", "null"], "minLength": 2}'), F.lit('{"$ref": "#/definitions/a"}'), F.lit('{"type": "text"}')), k)
    return t.part.select("p_partkey", J.schema_is_valid(s).alias("valid"))


@query("j04_under_path", "SELECT p_partkey FROM part WHERE p_type ILIKE 'promo%'")
def _(t):
    from corpusloom.operators.joins import under_path

    return t.part.where(under_path(c("p_type"), "promo", True)).select("p_partkey")


@query("j10_parents", "SELECT a.n_nationkey, b.n_name parent_n_name FROM nation a LEFT JOIN nation b ON a.n_regionkey = b.n_nationkey")
def _(t):
    from corpusloom.operators.joins import with_parent_row

    return with_parent_row(t.nation.select("n_nationkey", "n_name", c("n_regionkey").alias("up")), "n_nationkey", "up", ["n_name"]).select("n_nationkey", "parent_n_name")


@query("a12_timeline", "SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id, event_type)::int AS line, event_id || ' ' || event_type || ' [' || coalesce(props, '?') || ']' AS text FROM events")
def _(t):
    return M.audit_timeline(t.events, "user_id", "event_id", "event_type", "props")


@query("x05_sections", r"SELECT p_partkey, CASE p_partkey % 2 WHEN 0 THEN 'a ' || p_name || ' / ' || p_type || chr(10) || 'b' ELSE p_name || chr(10) || '2' || chr(10) || '3' || chr(10) || '4' || chr(10) || '5 / 6' END parts FROM part")
def _(t):
    even = F.concat(F.lit("\n\na "), c("p_name"), F.lit("\n \n\n"), c("p_type"), F.lit("\nb\n"))
    return t.part.select("p_partkey", F.array_join(E.sections(F.when(c("p_partkey") % 2 == 0, even).otherwise(F.concat("p_name", F.lit("\n2\n3\n4\n5\n6")))), " / ").alias("parts"))


@query("s15_merged_pools", r"""WITH u AS (SELECT instruction, plang, 'p' || pool_id id FROM pool_todo UNION ALL SELECT instruction, plang, 't' || strftime(generated_at, '%Y%m%d%H%M%S') || key FROM teacher_gen),
 n AS (SELECT *, nullif(lower(regexp_replace(coalesce(instruction, ''), '^[\s\x{A0}\x{0B}]+|[\s\x{A0}\x{0B}]+$', '', 'g')), '') k FROM u) SELECT min(id) id FROM n WHERE k IS NOT NULL GROUP BY k""")
def _(t):
    from corpusloom.operators.dedup import merged_pools

    a = t.pool_todo.select("instruction", "plang", F.concat(F.lit("p"), c("pool_id").cast("string")).alias("id"))
    b = t.teacher_gen.select("instruction", "plang", F.concat(F.lit("t"), F.date_format("generated_at", "yyyyMMddHHmmss"), "key").alias("id"))
    return merged_pools([a, b], "instruction", "plang", ["id"]).select("id")


@query("s20_shuffled_head", f"SELECT doc_id FROM documents ORDER BY {_chance(42, 'doc_id')}, doc_id LIMIT 40")
def _(t):
    d = t.documents.select("doc_id")
    return L.shuffled_head([d.where("doc_id % 2 = 0"), d.where("doc_id % 2 = 1")], "doc_id", 42, 40)


@query("l04_first_passing", "SELECT doc_id FROM documents WHERE n_chars >= 300 ORDER BY doc_id LIMIT 110")
def _(t):
    return L.first_passing(t.documents.select("doc_id", "n_chars"), c("n_chars") >= 300, ["doc_id"], 3 * 20 + 50).select("doc_id")
