"""Aggregations and metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import pyregex
from corpusloom.operators.ranks import place, running


def histogram(df: DataFrame, value: Column, missing: str = "?") -> DataFrame:
    """A1, A2: rows by value, nulls under ``missing``."""
    return df.groupBy(F.coalesce(value, F.lit(missing)).alias("value")).agg(F.count("*").alias("n"))


def kept_by_source(df: DataFrame, source: Column, kept: Column) -> DataFrame:
    """A3: scanned and kept rows by source and the source's percentage of all kept ones."""
    t = df.groupBy(F.coalesce(source, F.lit("?")).alias("source")).agg(F.count("*").alias("scanned"), F.count_if(kept).alias("kept"))
    whole = t.agg(F.sum("kept").alias("_all"))
    return t.join(F.broadcast(whole), F.lit(True)).select("source", "scanned", "kept", F.round(100 * F.try_divide("kept", "_all"), 4).alias("percent"))


def percentiles(df: DataFrame, by: Sequence[str], value: str, asked: Mapping[str, tuple[str, float]]) -> DataFrame:
    """Percentiles by group under the names asked for, each as (rule, q): ``floor``, the value at place floor(n q), from 0, of the sorted ones;
    ``nearest``, the one at place ceil(n q), from 1; ``interpolated``, between the two about (n - 1) q.

    Values are counted first, and running counts over ranges of the distinct ones tell their places: no task holds a group. Nulls don't count.
    """
    c = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_c"))
    r = running(c, by, [value], "_c")
    n, upto = F.col("_all"), F.col("_upto")
    first = lambda k: F.min(F.when(upto > k, F.col(value)))  # noqa: E731  # the value at place k, from 0
    out = []
    for name, (rule, q) in asked.items():
        if rule == "interpolated":
            at = (n - 1) * F.lit(q)
            low, high = first(F.floor(at)), first(F.ceil(at))
            out.append((low + (high - low) * F.max(at - F.floor(at))).alias(name))
        else:
            k = F.least(n - 1, F.floor(n * F.lit(q))) if rule == "floor" else F.greatest(F.lit(0), F.ceil(n * F.lit(q)) - 1)
            out.append(first(k).alias(name))
    return r.groupBy(*by).agg(*out)


def shares(df: DataFrame, by: Sequence[str], weight: Column) -> DataFrame:
    """A10: rows and weight of each group, and both as percentages."""
    t = df.groupBy(*by).agg(F.count("*").alias("n_rows"), F.sum(weight).alias("weight"))
    whole = t.agg(F.sum("n_rows").alias("_n"), F.sum("weight").alias("_w"))
    return t.join(F.broadcast(whole), F.lit(True)).select(*by, "n_rows", "weight", F.round(100 * F.col("n_rows") / F.col("_n"), 4).alias("row_percent"), F.round(100 * F.try_divide("weight", "_w"), 4).alias("weight_percent"))


def topic(q: Column, a: Column, topics: dict[str, tuple[str, str]], head: int = 400) -> Column:
    """The first subject whose keywords stand in the first ``head`` characters of both texts, else other."""
    t = F.substring(F.concat(F.coalesce(q, F.lit("")), F.lit(" "), F.coalesce(a, F.lit(""))), 1, head)
    out = None
    for name, (latin, other) in topics.items():
        cond = t.rlike(pyregex(rf"\b(?:{latin})\b|(?:{other})", True))
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out.otherwise("other")


def largest_share(counts: DataFrame, n: str = "n") -> DataFrame:
    """The largest group's share of all."""
    return counts.agg((F.max(n) / F.sum(n)).alias("largest_share"), F.count("*").alias("groups"))


def tool_summary(log: DataFrame, by: Sequence[str]) -> DataFrame:
    """Calls, successes, errors, confirmed calls and time of each tool, in one pass."""
    return log.groupBy(*by).agg(F.count("*").alias("calls"), F.count_if(F.col("status") == "success").alias("succeeded"), F.count_if(F.col("status") == "error").alias("failed"), F.coalesce(F.sum("ms"), F.lit(0)).alias("ms"))


def thread_summary(mail: DataFrame, thread: str, subject: Column, at: str, who: str) -> DataFrame:
    """Messages, first subject, first and last time, distinct participants and subjects of each thread."""
    return mail.groupBy(thread).agg(F.count("*").alias("messages"), F.min_by(subject, at).alias("subject"), F.min(at).alias("first_at"), F.max(at).alias("last_at"), F.countDistinct(who).alias("participants"), F.countDistinct(subject).alias("subjects"))


def pass_rates(runs: DataFrame, task: str, by: Sequence[str]) -> DataFrame:
    """By group, the means over tasks of pass rate, sample deviation of the duration (0 for one run) and mean duration."""
    per = runs.groupBy(*by, task).agg(F.avg(F.col("passed").cast("double")).alias("rate"), F.coalesce(F.stddev_samp("duration"), F.lit(0.0)).alias("deviation"), F.avg("duration").alias("mean"))
    return per.groupBy(*by).agg(F.count("*").alias("tasks"), F.avg("rate").alias("pass_rate"), F.avg("deviation").alias("deviation"), F.avg("mean").alias("mean_duration"))


def layered(calls: DataFrame, by: Sequence[str]) -> DataFrame:
    """Parseable calls, those of them with the right name, and those of these with the right arguments."""
    p, n, a = F.col("parseable"), F.col("name_ok"), F.col("args_ok")
    return calls.groupBy(*by).agg(F.count("*").alias("calls"), F.count_if(p).alias("parseable"), F.count_if(p & n).alias("named"), F.count_if(p & n & a).alias("exact"))


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Counts of every pair of classes that either side has, zeros filled in."""
    classes = df.select(F.col(truth).alias("c")).union(df.select(F.col(predicted))).where("c is not null").distinct()
    grid = classes.select(F.col("c").alias("truth")).crossJoin(F.broadcast(classes.select(F.col("c").alias("predicted"))))
    n = df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))
    return grid.join(n, ["truth", "predicted"], "left").select("truth", "predicted", F.coalesce("n", F.lit(0)).alias("n"))


def precision_recall(df: DataFrame, label: str, truth: Column, predicted: Column) -> DataFrame:
    """Precision, recall and F1 of each label, 0 where they are undefined, of (label, truth, predicted) rows."""
    c = df.groupBy(label).agg(F.count_if(truth & predicted).alias("tp"), F.count_if(~truth & predicted).alias("fp"), F.count_if(truth & ~predicted).alias("fn"))
    p, r = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0)), F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0))
    f = F.coalesce(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0))
    return c.select(label, "tp", "fp", "fn", p.alias("precision"), r.alias("recall"), f.alias("f1"))


def average_precision(df: DataFrame, by: Sequence[str], score: str, truth: str) -> DataFrame:
    """Average precision by group; equal scores are one step. Distinct scores are counted first."""
    c = df.groupBy(*by, score).agg(F.count("*").alias("n"), F.count_if(truth).alias("p"))
    w = Window.partitionBy(*by).orderBy(F.col(score).desc())
    run = c.withColumn("tp", F.sum("p").over(w)).withColumn("all", F.sum("n").over(w)).withColumn("total", F.sum("p").over(Window.partitionBy(*by)))
    return run.groupBy(*by).agg(F.coalesce(F.sum(F.try_divide(F.col("p"), F.col("total")) * F.col("tp") / F.col("all")), F.lit(0.0)).alias("average_precision"))


def tune_threshold(df: DataFrame, score: str, truth: str) -> DataFrame:
    """The threshold of 0.05 to 0.95 in steps of 0.01 with the best F1, of equals the one nearest to 0.5.

    Scores are counted by the step they reach, so the thresholds see running sums and not the rows.
    """
    step = F.least(F.lit(95), F.floor(F.col(score) * 100 + 1e-9)).cast("int")
    c = df.where(F.col(score).isNotNull()).groupBy(step.alias("s")).agg(F.count("*").alias("n"), F.count_if(truth).alias("p"))
    grid = df.sparkSession.range(0, 96).select(F.col("id").cast("int").alias("s"))
    w = Window.orderBy(F.col("s").desc())  # 96 rows
    run = grid.join(c.where("s >= 0"), "s", "left").select("s", F.sum(F.coalesce("n", F.lit(0))).over(w).alias("flagged"), F.sum(F.coalesce("p", F.lit(0))).over(w).alias("tp"))
    whole = df.where(F.col(score).isNotNull()).agg(F.count_if(truth).alias("all"))
    f1 = run.where("s >= 5").join(F.broadcast(whole), F.lit(True)).select((F.col("s") / 100).alias("threshold"), F.coalesce(F.try_divide(2 * F.col("tp"), F.col("flagged") + F.col("all")), F.lit(0.0)).alias("f1"))
    return f1.agg(F.max_by("threshold", F.struct(F.round("f1", 12), -F.round(F.abs(F.col("threshold") - 0.5), 6))).alias("threshold"), F.max("f1").alias("f1"))


def rewards(completion: Column, truth: Column) -> dict[str, Column]:
    """Rewards of an answer with reasoning and solution marks: exact format, approximate format, the answer and its number."""
    shape = completion.rlike(r"(?s)^\s*<start_working_out>.+?<end_working_out>.*?<SOLUTION>(.+?)</SOLUTION>\s*$")
    marks = ["<start_working_out>", "<end_working_out>", "<SOLUTION>", "</SOLUTION>"]
    one = [F.when((F.length(completion) - F.length(F.replace(completion, F.lit(m), F.lit("")))) / len(m) == 1, 0.5).otherwise(-1.0) for m in marks]
    approx = one[0] + one[1] + one[2] + one[3]
    got = F.regexp_extract(completion, r"(?s)<SOLUTION>(.+?)</SOLUTION>", 1)
    ratio = F.try_divide(got.try_cast("double"), truth.try_cast("double"))
    answer = F.when(got == "", -2.0).when(got == truth, 5.0).when(F.trim(got) == F.trim(truth), 3.5).when(ratio.isNull(), -4.5).when(ratio.between(0.9, 1.1), 2.0).when(ratio.between(0.8, 1.2), 1.5).otherwise(-2.5)
    number = F.regexp_extract(completion, r"(?s)<SOLUTION>.*?(-?[\d,\.]+)", 1)
    n = F.regexp_replace(number, ",", "").try_cast("double")
    num = F.when(number == "", -2.5).when(n.isNull() | truth.try_cast("double").isNull(), 0.0).when(n == truth.try_cast("double"), 3.5).otherwise(-1.5)
    return {"format": F.when(shape, 3.0).otherwise(0.0), "approximate": approx, "answer": answer, "number": num}


def parameter_score(tool_ok: Column, got: Column, want: Column) -> Column:
    """0.3 tool, 0.3 recall of parameters, 0.3 right values, 0.1 less a quarter for each parameter that wasn't wanted, of maps."""
    gk, wk = F.map_keys(got), F.map_keys(want)
    n = F.size(wk)
    recall = F.when(n == 0, 1.0).otherwise(F.size(F.array_intersect(gk, wk)) / n)
    right = F.when(n == 0, 1.0).otherwise(F.size(F.filter(wk, lambda k: F.try_element_at(got, k).eqNullSafe(F.try_element_at(want, k)))) / n)
    extra = F.greatest(F.lit(0.0), 1 - 0.25 * F.size(F.array_except(gk, wk)))
    return 0.3 * tool_ok.cast("double") + 0.3 * recall + 0.3 * right + 0.1 * extra


def inverse_quota(df: DataFrame, score: str, total: int) -> DataFrame:
    """Quota of each row in proportion to 1 / (score + 0.1), half-even, one at least."""
    w = 1 / (F.col(score) + 0.1)
    s = df.agg(F.sum(w).alias("_all"))
    return df.join(F.broadcast(s), F.lit(True)).select(*df.columns, F.greatest(F.lit(1), F.bround(w / F.col("_all") * total).cast("long")).alias("quota"))


def run_summary(steps: DataFrame, run: str) -> DataFrame:
    """The best evaluation and its step, the final one, how far it rose, and whether it is over 1.5 times the training loss. Of equal steps the greatest values count."""
    final, train = F.max(F.struct("step", "eval"))["eval"], F.max(F.struct("step", "train"))["train"]
    return steps.groupBy(run).agg(F.min(F.struct("eval", "step"))["step"].alias("best_step"), F.min("eval").alias("best"), final.alias("final"), (final - F.min("eval")).alias("rise"), (final / train > 1.5).alias("overfit"))


def provenance(df: DataFrame, text: str) -> DataFrame:
    """Rows, and the median, 90th percentile and largest number of words (floor index), by counted lengths."""
    from corpusloom.functions.text import word_count

    n = df.select(word_count(F.coalesce(F.col(text), F.lit(""))).alias("n"))
    c = n.groupBy("n").agg(F.count("*").alias("c"))
    w = Window.orderBy("n")  # one row for each distinct length
    run = c.select("n", F.sum("c").over(w).alias("upto"), F.sum("c").over(Window.partitionBy()).alias("all"))
    at = lambda q: F.min(F.when(F.col("upto") > F.least(F.col("all") - 1, F.floor(F.col("all") * q)), F.col("n")))
    return run.agg(F.max("all").alias("n_rows"), at(0.5).alias("median_words"), at(0.9).alias("p90_words"), F.max("n").alias("max_words"))


def token_ledger(df: DataFrame, by: Sequence[str], tokens_in: str, tokens_out: str, price_in: float, price_out: float, local: Column) -> DataFrame:
    """Tokens, their cost and what rows answered locally saved, by group."""
    cost = F.col(tokens_in) / 1e6 * price_in + F.col(tokens_out) / 1e6 * price_out
    return df.groupBy(*by).agg(F.sum(tokens_in).alias("tokens_in"), F.sum(tokens_out).alias("tokens_out"), F.round(F.sum(F.when(~local, cost).otherwise(0.0)), 8).alias("spent"), F.round(F.sum(F.when(local, cost).otherwise(0.0)), 8).alias("saved"), F.round(100 * F.avg(local.cast("double")), 4).alias("percent_local"))


def audit_timeline(log: DataFrame, session: str, at: str, tool: str, status: str) -> DataFrame:
    """(session, line, text) of each call in order of time: a report's lines, as rows. A hot session is put in order range by range."""
    p = place(log.select(session, at, tool, status), [session], [at, tool])
    return p.select(session, F.col("_place").cast("int").alias("line"), F.concat_ws(" ", F.col(at).cast("string"), tool, F.concat(F.lit("["), F.coalesce(status, F.lit("?")), F.lit("]"))).alias("text"))
