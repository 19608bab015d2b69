"""Feature operators, one by one and as the whole workflow."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.catalog.clicks import TRAIN_DAYS, VALID_DAYS, clicks
from clickloom.catalog.sqltext import (
    coded,
    counts_cte,
    filled,
    moments_cte,
    rounded,
    transformed_columns_sql,
    transformed_ctes,
    vocab_ctes,
    with_clicks,
)
from clickloom.operators.lookup import Limits
from clickloom.operators.moments import moments_by_position
from clickloom.operators.vocab import (
    Vocabulary,
    cardinality_table,
    slot_offsets,
    unseen_values,
)
from clickloom.plans.ops import (
    Bucketize,
    Categorify,
    Clip,
    Cross,
    DateParts,
    DropMissing,
    FillMissing,
    FilterRange,
    Impute,
    Log1p,
    MissingFlag,
    MultiHotCategorify,
    Normalize,
    OneHot,
)
from clickloom.plans.workflow import FittedWorkflow, Workflow, click_workflow
from clickloom.schema import categorical_columns, continuous_columns
from clickloom.sources.scans import decode_categoricals
from clickloom.storage import materialize, scratch_path, short_methods

CATS, CONTS = categorical_columns(), continuous_columns()


def int_clicks(spark, sf):
    """The view with integer categoricals, derived and decoded once and written, as a conversion job leaves it."""
    with short_methods(spark):
        return materialize(decode_categoricals(clicks(spark, sf)), "clicks")


def rounded_columns(df, columns):
    return df.withColumns(
        {c: F.round(F.col(c).cast("double"), 4) + F.lit(0.0) for c in columns}
    )


def _fit_apply(df, train, stages, columns):
    """Fit the stages on `train`, apply them to `df`, keep the columns as they come."""
    states = []
    for stage in stages:
        state = stage.fit(train) if stage.fitted else None
        train, df = stage.apply(train, state), stage.apply(df, state)
        states.append(state)
    return df.select(*columns)


def fill_clip(spark, sf):
    stages = [FillMissing(CONTS, 0), Clip(CONTS, low=0)]
    df = clicks(spark, sf)
    return _fit_apply(df, df, stages, ["event_id", *CONTS])


def clip_both(spark, sf):
    df = clicks(spark, sf)
    return _fit_apply(df, df, [Clip(CONTS, low=0, high=100)], ["event_id", *CONTS])


def normalize(spark, sf):
    df = clicks(spark, sf)
    stages = [FillMissing(CONTS, 0), Clip(CONTS, low=0), Normalize(CONTS)]
    out = _fit_apply(df, df.where(TRAIN_DAYS), stages, ["event_id", *CONTS])
    return rounded_columns(out, CONTS)


def _train_vocab(df, max_size=None):
    return Vocabulary.fit(df.where(TRAIN_DAYS), CATS, max_size)


def vocab_fit(spark, sf):
    return _train_vocab(int_clicks(spark, sf)).table


def vocab_topn(spark, sf):
    return _train_vocab(int_clicks(spark, sf), 100).table


def cardinalities(spark, sf):
    return cardinality_table(_train_vocab(int_clicks(spark, sf)).table)


def offsets(spark, sf):
    return slot_offsets(cardinality_table(_train_vocab(int_clicks(spark, sf)).table), CATS)


def categorify(spark, sf):
    df = int_clicks(spark, sf)
    return _train_vocab(df).encode(df.select("event_id", *CATS))


#: Nothing fits a broadcast but the four most frequent values of a column, and what has a quarter of the rows.
TAIL_LIMITS = Limits(column_bytes=0, total_bytes=0, head_entries=4, hot_rows=1)


def categorify_tail(spark, sf):
    """`categorify` where every vocabulary is too large to broadcast."""
    df = int_clicks(spark, sf)
    return _train_vocab(df).encode(df.select("event_id", *CATS), limits=TAIL_LIMITS)


def categorify_string(spark, sf):
    df = clicks(spark, sf).select("event_id", "day", *CATS)
    vocab = Vocabulary.fit(df.where(TRAIN_DAYS), CATS)
    return vocab.encode(df).drop("day")


def categorify_topn(spark, sf):
    df = int_clicks(spark, sf)
    return _train_vocab(df, 100).encode(df.select("event_id", *CATS))


FLAGS = ["l_returnflag", "l_linestatus"]


def categorify_lineitem(spark, sf):
    """Ints and text of a sales table, in one vocabulary."""
    df = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *FLAGS
    )
    return Vocabulary.fit(df, ["l_partkey", "l_suppkey", *FLAGS]).encode(df)


# Columns of text, integers, fractions, a time, a date and a truth value.
MIXED = {
    "l_shipmode": "concat(l_returnflag, l_linestatus)", "l_suppkey": "l_suppkey - 40", "l_quantity": "l_quantity - 25.5",
    "l_shipdate": "l_shipdate", "l_day": "CAST(l_shipdate AS DATE)", "l_small": "l_quantity < 10",
}


def _mixed(spark, sf):
    columns = [f"{expression} AS {name}" for name, expression in MIXED.items()]
    return spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr("l_orderkey", "l_linenumber", *columns)


def vocab_mixed(spark, sf):
    """One fit over columns of six types; values of each in the order of its own type."""
    return Vocabulary.fit(_mixed(spark, sf), list(MIXED)).table


def categorify_mixed(spark, sf):
    df = _mixed(spark, sf)
    return Vocabulary.fit(df, list(MIXED), 40).encode(df)


def vector_normalize(spark, sf):
    """Vectors filled, clipped and normalized position by position, as one column of a workflow."""
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    gaps = F.transform("embedding", lambda v, i: F.when((F.col("vec_id") + i) % 11 != 0, v))
    stages = [FillMissing(["embedding"], 0), Clip(["embedding"], -0.25, 0.25), Normalize(["embedding"])]
    fitted = Workflow(stages, ["embedding"]).fit(df.withColumn("embedding", gaps).where("vec_id % 5 > 0"))
    path = scratch_path(spark, "vectors")
    fitted.save(path)
    done = FittedWorkflow.load(spark, path).transform(df.withColumn("embedding", gaps), "vec_id")
    each = done.select("vec_id", F.posexplode("embedding").alias("pos", "v"))
    return each.select("vec_id", "pos", (F.round(F.col("v").cast("double"), 4) + 0.0).alias("v"))


def vector_moments(spark, sf):
    """Mean and deviation of every position of the vectors."""
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rounded_ = [(F.round(c, 6) + 0.0).alias(c) for c in ("mean", "std")]
    return moments_by_position(df, ["embedding"]).select("col", "pos", *rounded_)


def unseen(spark, sf):
    df = int_clicks(spark, sf)
    vocab = Vocabulary.fit(df.where(TRAIN_DAYS), CATS)
    return unseen_values(df.where(VALID_DAYS), vocab.table, CATS)


def fitted_workflow(df) -> FittedWorkflow:
    return click_workflow().fit(df.where(TRAIN_DAYS))


def _workflow(spark, sf, days):
    df = int_clicks(spark, sf)
    fitted = fitted_workflow(df)
    return rounded_columns(fitted.transform(df.where(days) if days else df, "event_id"), CONTS)


def workflow_train(spark, sf):
    return _workflow(spark, sf, TRAIN_DAYS)


def workflow_valid(spark, sf):
    return _workflow(spark, sf, VALID_DAYS)


def workflow_all(spark, sf):
    return _workflow(spark, sf, None)


def workflow_reload(spark, sf):
    path = scratch_path(spark, "workflow")
    df = int_clicks(spark, sf)
    fitted_workflow(df).save(path)
    fitted = FittedWorkflow.load(spark, path)
    return rounded_columns(fitted.transform(df, "event_id"), CONTS)


def filter_outliers(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    return FilterRange(["o_totalprice"], 1000.0, 200000.0).apply(orders, None).select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


def drop_missing(spark, sf):
    return DropMissing(["I1", "C1"]).apply(clicks(spark, sf), None).select("event_id", "I1", "C1")


def missing_flag(spark, sf):
    df = MissingFlag(CONTS + CATS).apply(clicks(spark, sf), None)
    return df.select("event_id", *[f"{c}_missing" for c in CONTS + CATS])


def _impute(strategy, value=None):
    def run(spark, sf):
        df = clicks(spark, sf)
        out = _fit_apply(
            df, df.where(TRAIN_DAYS), [Impute(CONTS, strategy, value)], ["event_id", *CONTS]
        )
        return rounded_columns(out, CONTS)

    return run


EDGES = [5, 10, 20, 30, 40]


def bucketize(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet").select("p_partkey", "p_size")
    return Bucketize(["p_size"], EDGES).apply(part, None)


def date_parts(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "ts")
    return DateParts(["ts"]).apply(events, None).drop("ts")


def cross(spark, sf):
    df = clicks(spark, sf).select("event_id", "day", "C1", "C2")
    crossed = Cross(["C1", "C2"], "C1_C2").apply(df, None)
    vocab = Vocabulary.fit(crossed.where(TRAIN_DAYS), ["C1_C2"])
    return vocab.encode(crossed.select("event_id", "C1_C2"))


def log1p(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "value")
    return rounded_columns(Log1p(["value"]).apply(events, None), ["value"])


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def one_hot(spark, sf):
    customer = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", "c_mktsegment")
    return OneHot(["c_mktsegment"], SEGMENTS).apply(customer, None)


def lists(spark, sf):
    return int_clicks(spark, sf).select(
        "event_id", "day", F.array_compact(F.array("C1", "C2")).alias("M")
    )


def multi_hot(spark, sf):
    df = lists(spark, sf)
    op = MultiHotCategorify(["M"], nnz=2)
    out = op.apply(df, op.fit(df.where(TRAIN_DAYS)), "event_id")
    return out.select("event_id", F.array_join(F.col("M").cast("array<string>"), ",").alias("M"))


LONG = ["C1", "C2", "C3", "C4", "C5", "C6"]


def multi_hot_cut(spark, sf):
    """Lists of up to six values, of which the three most frequent are kept; codes beyond 40 count as unseen."""
    df = int_clicks(spark, sf).select("event_id", "day", F.array_compact(F.array(*LONG)).alias("M"))
    op = MultiHotCategorify(["M"], nnz=3, max_size=41)
    out = op.apply(df, op.fit(df.where(TRAIN_DAYS)), "event_id")
    return out.select("event_id", F.array_join(F.col("M").cast("array<string>"), ",").alias("M"))


def categorify_unseen(spark, sf):
    """Nine of ten values unseen, where no vocabulary can be broadcast."""
    df = int_clicks(spark, sf)
    rows = df.select("event_id", *[F.when(F.col("event_id") % 10 == 0, F.col(c)).otherwise(F.col("event_id") * 7 + 3).alias(c) for c in CATS])
    return _train_vocab(df).encode(rows, limits=TAIL_LIMITS)


QUERIES = {
    "fill_clip": fill_clip,
    "clip_both": clip_both,
    "normalize": normalize,
    "vocab_fit": vocab_fit,
    "vocab_topn": vocab_topn,
    "cardinalities": cardinalities,
    "slot_offsets": offsets,
    "categorify": categorify,
    "categorify_tail": categorify_tail,
    "categorify_string": categorify_string,
    "categorify_topn": categorify_topn,
    "categorify_lineitem": categorify_lineitem,
    "vocab_mixed": vocab_mixed,
    "categorify_mixed": categorify_mixed,
    "vector_normalize": vector_normalize,
    "vector_moments": vector_moments,
    "unseen_values": unseen,
    "workflow_train": workflow_train,
    "workflow_valid": workflow_valid,
    "workflow_all": workflow_all,
    "workflow_reload": workflow_reload,
    "filter_outliers": filter_outliers,
    "drop_missing": drop_missing,
    "missing_flag": missing_flag,
    "impute_constant": _impute("constant", -1.0),
    "impute_mean": _impute("mean"),
    "impute_median": _impute("median"),
    "bucketize": bucketize,
    "date_parts": date_parts,
    "cross": cross,
    "log1p": log1p,
    "one_hot": one_hot,
    "multi_hot": multi_hot,
    "multi_hot_cut": multi_hot_cut,
    "categorify_unseen": categorify_unseen,
}


def _mixed_vocab_sql():
    """`mixed` and its `vocab`; each column is counted and ranked on its own."""
    each = [
        f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS value, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, {c}) AS code "
        f"FROM mixed GROUP BY {c}"
        for c in MIXED
    ]
    columns = ", ".join(f"{expression} AS {name}" for name, expression in MIXED.items())
    return f"mixed AS (SELECT l_orderkey, l_linenumber, {columns} FROM lineitem), vocab AS ({' UNION ALL '.join(each)})"


def _categorify_sql(ints, max_size=None):
    items, joins = coded(CATS)
    return with_clicks(
        f"SELECT c.event_id, {items} FROM clicks c {joins}", ints, *vocab_ctes(CATS, max_size)
    )


def _workflow_sql(days):
    return with_clicks(
        f"SELECT {transformed_columns_sql()} FROM done" + (f" WHERE {days}" if days else ""),
        True,
        *transformed_ctes(),
    )


def _impute_sql(value):
    items = ", ".join(
        f"{rounded(f'coalesce({c}, ' + (value.format(c)) + ')')} AS {c}" for c in CONTS
    )
    return with_clicks(f"SELECT event_id, {items} FROM clicks", False)


def _lineitem_sql():
    columns = ["l_partkey", "l_suppkey", *FLAGS]
    ctes = ", ".join(
        f"v{c} AS (SELECT {c} AS value, row_number() OVER (ORDER BY count(*) DESC, {c}) AS code "
        f"FROM lineitem GROUP BY {c})"
        for c in columns
    )
    joins = " ".join(f"JOIN v{c} ON v{c}.value = l.{c}" for c in columns)
    items = ", ".join(f"v{c}.code AS {c}" for c in columns)
    return f"WITH {ctes} SELECT l.l_orderkey, l.l_linenumber, {items} FROM lineitem l {joins}"


LIST_CTES = [
    "lists AS (SELECT event_id, day, C1 AS value FROM clicks WHERE C1 IS NOT NULL UNION ALL "
    "SELECT event_id, day, C2 AS value FROM clicks WHERE C2 IS NOT NULL)",
    "listvocab AS (SELECT value, row_number() OVER (ORDER BY count(*) DESC, value) AS code "
    f"FROM lists WHERE {TRAIN_DAYS} GROUP BY value)",
    "coded AS (SELECT c.event_id, coalesce(v.code, 0) AS code FROM lists c "
    "LEFT JOIN listvocab v USING (value))",
]

SQL = {
    "multi_hot_cut": with_clicks(
        "SELECT c.event_id, coalesce(l.M, '') AS M FROM clicks c LEFT JOIN (SELECT event_id, array_to_string(list(code ORDER BY code)[1:3], ',') AS M "
        "FROM (SELECT v.event_id, CASE WHEN k.code <= 40 THEN k.code ELSE 0 END AS code FROM long_lists v LEFT JOIN long_vocab k USING (value)) "
        "GROUP BY event_id) l USING (event_id)",
        True,
        "long_lists AS (" + " UNION ALL ".join(f"SELECT event_id, day, {c} AS value FROM clicks WHERE {c} IS NOT NULL" for c in LONG) + ")",
        f"long_vocab AS (SELECT value, row_number() OVER (ORDER BY count(*) DESC, value) AS code FROM long_lists WHERE {TRAIN_DAYS} GROUP BY value)",
    ),
    "categorify_unseen": with_clicks(
        "SELECT c.event_id, " + ", ".join(f"coalesce(v{c}.code, 0) AS {c}" for c in CATS) + " FROM clicks c "
        + " ".join(
            f"LEFT JOIN vocab v{c} ON v{c}.col = '{c}' AND v{c}.value = CASE WHEN c.event_id % 10 = 0 THEN c.{c} ELSE c.event_id * 7 + 3 END"
            for c in CATS
        ),
        True,
        *vocab_ctes(CATS),
    ),
    "fill_clip": with_clicks(
        "SELECT event_id, " + ", ".join(f"{filled(c)} AS {c}" for c in CONTS) + " FROM clicks", False
    ),
    "clip_both": with_clicks(
        "SELECT event_id, "
        + ", ".join(
            f"CASE WHEN {c} IS NOT NULL THEN least(greatest({c}, 0), 100) END AS {c}" for c in CONTS
        )
        + " FROM clicks",
        False,
    ),
    "normalize": with_clicks(
        "SELECT c.event_id, "
        + ", ".join(
            rounded(f"CAST(({filled('c.' + c)} - m{c}) / s{c} AS FLOAT)") + f" AS {c}" for c in CONTS
        )
        + " FROM clicks c, moments",
        False,
        moments_cte(CONTS),
    ),
    "vocab_fit": with_clicks("SELECT col, CAST(value AS BIGINT) AS value, n, code FROM vocab", True, *vocab_ctes(CATS)),
    "vocab_topn": with_clicks("SELECT col, CAST(value AS BIGINT) AS value, n, code FROM vocab", True, *vocab_ctes(CATS, 100)),
    "cardinalities": with_clicks(
        "SELECT col, count(*) + 1 AS cardinality FROM counts GROUP BY col",
        True,
        counts_cte("train", CATS),
    ),
    "slot_offsets": with_clicks(
        "SELECT slot, col, cardinality, CAST(coalesce(sum(cardinality) OVER (ORDER BY slot ROWS "
        "BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS \"offset\" FROM (SELECT "
        "CAST(substr(col, 2) AS INTEGER) - 1 AS slot, col, count(*) + 1 AS cardinality "
        "FROM counts GROUP BY col)",
        True,
        counts_cte("train", CATS),
    ),
    "categorify": _categorify_sql(True),
    "categorify_tail": _categorify_sql(True),
    "categorify_string": _categorify_sql(False),
    "categorify_topn": _categorify_sql(True, 100),
    "categorify_lineitem": _lineitem_sql(),
    "vocab_mixed": f"WITH {_mixed_vocab_sql()} SELECT * FROM vocab",
    "categorify_mixed": f"WITH {_mixed_vocab_sql()} SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"CASE WHEN v{c}.code < 40 THEN v{c}.code ELSE 0 END AS {c}" for c in MIXED)
    + " FROM mixed "
    + " ".join(f"LEFT JOIN vocab v{c} ON v{c}.col = '{c}' AND v{c}.value = CAST(mixed.{c} AS VARCHAR)" for c in MIXED),
    "vector_moments": "SELECT 'embedding' AS col, CAST(pos AS INTEGER) AS pos, round(avg(CAST(v AS DOUBLE)), 6) + 0.0 AS mean, "
    "round(stddev_samp(CAST(v AS DOUBLE)), 6) + 0.0 AS std FROM (SELECT unnest(embedding) AS v, "
    "generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings) GROUP BY pos",
    "vector_normalize": "WITH e AS (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings), "
    "c AS (SELECT vec_id, pos, greatest(least(CASE WHEN (vec_id + pos) % 11 = 0 THEN 0 ELSE CAST(v AS DOUBLE) END, 0.25), -0.25) AS v FROM e), "
    "m AS (SELECT pos, avg(v) AS mean, stddev_samp(v) AS std FROM c WHERE vec_id % 5 > 0 GROUP BY pos) "
    "SELECT vec_id, CAST(c.pos AS INTEGER) AS pos, round(CAST(CAST((v - mean) / std AS FLOAT) AS DOUBLE), 4) + 0.0 AS v FROM c JOIN m USING (pos)",
    "unseen_values": with_clicks(
        "SELECT v.col, CAST(v.value AS BIGINT) AS value, v.n FROM seen v LEFT JOIN counts t ON t.col = v.col "
        "AND t.value = v.value WHERE t.col IS NULL",
        True,
        f"valid AS (SELECT * FROM clicks WHERE {VALID_DAYS})",
        counts_cte("train", CATS),
        counts_cte("valid", CATS, "seen"),
    ),
    "workflow_train": _workflow_sql(TRAIN_DAYS),
    "workflow_valid": _workflow_sql(VALID_DAYS),
    "workflow_all": _workflow_sql(None),
    "workflow_reload": _workflow_sql(None),
    "filter_outliers": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders "
    "WHERE o_totalprice BETWEEN 1000 AND 200000",
    "drop_missing": with_clicks(
        "SELECT event_id, I1, C1 FROM clicks WHERE I1 IS NOT NULL AND C1 IS NOT NULL", False
    ),
    "missing_flag": with_clicks(
        "SELECT event_id, "
        + ", ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END AS {c}_missing" for c in CONTS + CATS)
        + " FROM clicks",
        False,
    ),
    "impute_constant": _impute_sql("-1.0"),
    "impute_mean": _impute_sql("(SELECT avg({}) FROM train)"),
    "impute_median": _impute_sql("(SELECT quantile_cont({}, 0.5) FROM train)"),
    "bucketize": "SELECT p_partkey, "
    + " + ".join(f"CASE WHEN p_size >= {e} THEN 1 ELSE 0 END" for e in EDGES)
    + " AS p_size FROM part",
    "date_parts": "SELECT event_id, CAST(dayofweek(ts) + 1 AS INTEGER) AS ts_dayofweek, "
    "CAST(month(ts) AS INTEGER) AS ts_month, CAST(day(ts) AS INTEGER) AS ts_dayofmonth FROM events",
    "cross": with_clicks(
        "SELECT x.event_id, coalesce(v.code, 0) AS C1_C2 FROM crossed x LEFT JOIN cv v ON v.value = x.value",
        False,
        "crossed AS (SELECT event_id, day, C1 || '_' || C2 AS value FROM clicks)",
        "cv AS (SELECT value, row_number() OVER (ORDER BY count(*) DESC, value) AS code "
        f"FROM crossed WHERE {TRAIN_DAYS} AND value IS NOT NULL GROUP BY value)",
    ),
    "log1p": f"SELECT event_id, {rounded('ln(1 + value)')} AS value FROM events",
    "one_hot": "SELECT c_custkey, c_mktsegment, "
    + ", ".join(
        f"CASE WHEN c_mktsegment = '{s}' THEN 1 ELSE 0 END AS c_mktsegment_{s}" for s in SEGMENTS
    )
    + " FROM customer",
    "multi_hot": with_clicks(
        "SELECT c.event_id, coalesce(l.m, '') AS M FROM clicks c LEFT JOIN (SELECT event_id, "
        "string_agg(CAST(code AS VARCHAR), ',' ORDER BY code) AS m FROM coded GROUP BY event_id) l "
        "USING (event_id)",
        True,
        *LIST_CTES,
    ),
}
