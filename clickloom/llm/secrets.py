"""Secret scan: three patterns, and a randomness test battery for every other long token.

Patterns give the kinds `assign`, `access` and `hex`. Tokens of 20 and more characters that
overlap none of them are put to the battery, each against the alphabet of its inferred
encoding, the smallest that holds it (hex, 26 letters, base32 or base36, each in lower or
upper case, or base64):

* chi-squared: are the characters uniform over the alphabet,
* runs: do characters of the upper and lower half of the alphabet alternate as by chance,
* serial correlation: does a character depend on the one before.

A token is random-looking when three times the smallest p-value is at least `least_random`.
How surprising that is for ordinary text grows with the length: the likelihood ratio of
uniform characters against a model of ordinary identifiers (letters by frequency, character
classes that rarely change) is an e-value, so its inverse is a p-value. Benjamini-Hochberg
over these, in each class of lengths on its own, keeps the expected share of ordinary tokens
among the found ones at `discovery` or less. The ranks come from a histogram of p-values,
which has a bounded number of rows, so no task ever sees all tokens.

Null and empty texts have no spans. Repeated rows are scanned one by one, an empty table
gives an empty result, and only the needed columns are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.storage import materialize

# The patterns, in the order in which spans of one start are listed.
PATTERNS = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}
LEAST = {"assign": 8, "access": 16, "hex": 32}
#: What finds the rows worth a closer look. Shorter runs are matches too, but all of them fail.
GATES = {"assign": r"(?i)(?:pass(?:word|wd)|secret|token|api_?key)", "access": r"AKIA[A-Z0-9]{12}", "hex": r"[0-9a-f]{32}"}
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
KINDS = (*PATTERNS, "random")

B64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
UPPER, LOWER, DIGITS = B64[:26], B64[26:52], B64[52:62]
# Smallest first: the characters of an encoding, as members of a regex class and in order.
ENCODINGS = [
    ("0-9a-f", "0123456789abcdef"), ("0-9A-F", "0123456789ABCDEF"),
    ("a-z", LOWER), ("A-Z", UPPER),
    ("a-z2-7", LOWER + "234567"), ("A-Z2-7", UPPER + "234567"),
    ("a-z0-9", LOWER + DIGITS), ("A-Z0-9", UPPER + DIGITS),
]
# Per cent of each letter in English text, a to z.
LETTER_SHARE = (
    8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4,
    6.7, 7.5, 1.9, 0.095, 6.0, 6.3, 9.1, 2.8, 0.98, 2.4, 0.15, 2.0, 0.074,
)
STAY = 0.9  # chance that ordinary text keeps to a class of characters
BINS_PER_NAT = 20
MOST_NATS = 400  # p-values below exp(-400) share the last bin


def found(text: Column, pattern: str, gate: str) -> Column:
    """Matches with the number of characters before each, counted from the match before.

    Splitting by the pattern gives exactly the stretches between its matches.
    """
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.zip_with(gaps, matches, lambda g, m: F.struct(g.alias("gap"), m.alias("match")))
    none = F.array().cast("array<struct<gap:int,match:string>>")
    return F.when(text.rlike(gate), F.filter(both, lambda x: x["match"].isNotNull())).otherwise(none)


def located(hits: DataFrame) -> DataFrame:
    """`row, kind, start, end, match` of every match that is long enough, in code points.

    Starts are running sums inside one text, by window: a text with very many matches stays
    linear and can spill.
    """
    to_here = Window.partitionBy("row", "kind").orderBy("pos")
    parts = []
    for kind in KINDS:
        parts.append(
            hits.where(F.size(kind) > 0)
            .select("row", F.lit(kind).alias("kind"), F.posexplode(kind).alias("pos", "hit"))
            .select("row", "kind", "pos", "hit.gap", "hit.match", F.length("hit.match").alias("n"))
        )
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    value = F.regexp_extract("match", PATTERNS["assign"], 2)
    long_enough = (
        F.when(F.col("kind") == "assign", F.length(value) >= LEAST["assign"])
        .when(F.col("kind") == "access", F.col("n") >= LEAST["access"])
        .when(F.col("kind") == "hex", F.col("n") >= LEAST["hex"])
        .otherwise(F.lit(True))
    )
    return (
        rows.withColumn("end", F.sum(F.col("gap") + F.col("n")).over(to_here))
        .where(long_enough)
        .select("row", "kind", (F.col("end") - F.col("n")).alias("start"), "end", "match")
    )


def uncovered(spans: DataFrame) -> DataFrame:
    """The tokens that overlap no span of a pattern, by two passes over each text's spans."""
    base = F.col("kind") != "random"
    upward = Window.partitionBy("row").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    downward = Window.partitionBy("row").orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, 0)
    return (
        spans.withColumn("_before", F.max(F.when(base, F.col("end"))).over(upward))
        .withColumn("_after", F.min(F.when(base, F.col("start"))).over(downward))
        .where(~base)
        .where(F.coalesce(F.col("_before") <= F.col("start"), F.lit(True)))
        .where(F.coalesce(F.col("_after") >= F.col("end"), F.lit(True)))
        .drop("_before", "_after")
    )


def two_sided(z: Column) -> Column:
    """Chance of a normal deviate as far out as z, after Abramowitz and Stegun 7.1.26."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return F.least(F.lit(1.0), poly * F.exp(-x * x))


def tested(tokens: DataFrame, token: str = "match") -> DataFrame:
    """Add `p_uniform, p_runs, p_serial, p_random, nats` to every token.

    `nats` is minus the logarithm of the chance that an ordinary token looks this random.
    Tokens of digits only infer no encoding.
    """
    t = F.col("_t")
    out = tokens.withColumn("_t", F.translate(F.rtrim(F.col(token), F.lit("=")), "-_", "+/"))
    inferred = F.when(t.rlike("^[0-9]*$"), F.lit(None))
    for members, letters in ENCODINGS:
        inferred = inferred.when(t.rlike(f"^[{members}]+$"), F.lit(letters))
    out = out.withColumn("_alphabet", inferred.otherwise(F.lit(B64))).where(F.col("_alphabet").isNotNull())
    chars = F.filter(F.split(t, ""), lambda c: c != "")
    out = out.withColumn("_chars", chars)
    alphabet = F.col("_alphabet")
    place = F.transform("_chars", lambda c: F.call_function("instr", alphabet, c) - 1)
    out = out.withColumn("_v", place)
    n, a = F.size("_v").cast("double"), F.length("_alphabet").cast("double")

    # The squares of the counts add up to 1 + 3 + 5 + ... along each run of equal sorted values.
    start = F.struct(F.lit(-1).alias("v"), F.lit(0).alias("run"), F.lit(0).cast("long").alias("sum"))

    def step(s, v):
        run = F.when(s["v"] == v, s["run"] + 1).otherwise(F.lit(1))
        return F.struct(v.alias("v"), run.alias("run"), (s["sum"] + 2 * run - 1).cast("long").alias("sum"))

    squares = F.aggregate(F.array_sort("_v"), start, step, lambda s: s["sum"])
    chi = a / n * squares - n
    z_chi = (chi - (a - 1)) / F.sqrt(2 * (a - 1) * (n - 1) / n)
    p_uniform = F.when(z_chi <= 0, F.lit(1.0)).otherwise(two_sided(z_chi))

    half = a / 2
    bits = F.transform("_v", lambda v: (v >= half).cast("int"))
    out = out.withColumn("_bits", bits).withColumn("_mean", F.aggregate("_v", F.lit(0.0), lambda s, v: s + v) / n)
    total = lambda array: F.aggregate(array, F.lit(0.0), lambda s, x: s + x)
    head = F.slice("_v", F.lit(1), F.size("_v") - 1)
    rest = F.slice("_v", F.lit(2), F.size("_v") - 1)
    changes = F.zip_with(
        F.slice("_bits", F.lit(1), F.size("_v") - 1), F.slice("_bits", F.lit(2), F.size("_v") - 1),
        lambda x, y: (x != y).cast("double"),
    )
    ones = total(F.transform("_bits", lambda b: b.cast("double")))
    pairs = 2 * ones * (n - ones)
    expected = pairs / n + 1
    spread = F.sqrt(pairs * (pairs - n) / (n * n * (n - 1)))
    p_runs = F.when(pairs == 0, F.pow(F.lit(0.5), n - 1)).otherwise(
        two_sided(F.coalesce((total(changes) + 1 - expected) / F.nullif(spread, F.lit(0.0)), F.lit(0.0)))
    )
    mean = F.col("_mean")
    lag = total(F.zip_with(head, rest, lambda x, y: (x - mean) * (y - mean)))
    power = total(F.transform("_v", lambda x: (x - mean) * (x - mean)))
    p_serial = F.when(power == 0, F.lit(0.0)).otherwise(
        two_sided((lag / F.nullif(power, F.lit(0.0)) + 1 / n) * F.sqrt(n))
    )

    share = sum(LETTER_SHARE)
    letters = [math.log(x / share) for x in LETTER_SHARE]
    by_code = [math.log(0.5)] * 128  # symbols: two of them in the alphabet
    for i in range(26):
        by_code[65 + i] = by_code[97 + i] = letters[i]
    for i in range(10):
        by_code[48 + i] = math.log(0.1)
    table = F.array(*[F.lit(x) for x in by_code])
    kind = [3] * 128
    for first, size, number in ((65, 26, 0), (97, 26, 1), (48, 10, 2)):
        kind[first : first + size] = [number] * size
    kinds = F.array(*[F.lit(x) for x in kind])
    out = out.withColumn("_codes", F.transform("_chars", lambda c: F.ascii(c)))
    within = total(F.transform("_codes", lambda c: F.element_at(table, c + 1)))
    out = out.withColumn("_kinds", F.transform("_codes", lambda c: F.element_at(kinds, c + 1)))
    moves = F.zip_with(
        F.slice("_kinds", F.lit(1), F.size("_v") - 1), F.slice("_kinds", F.lit(2), F.size("_v") - 1),
        lambda x, y: F.when(x == y, F.lit(math.log(STAY))).otherwise(F.lit(math.log((1 - STAY) / 3))),
    )
    out = out.withColumn("p_uniform", p_uniform).withColumn("p_runs", p_runs).withColumn("p_serial", p_serial)
    return (
        out.withColumn("p_random", F.least(F.lit(1.0), 3 * F.least("p_uniform", "p_runs", "p_serial")))
        .withColumn("nats", F.greatest(F.lit(0.0), -n * F.ln(a) - within - total(moves)))
        .drop("_t", "_alphabet", "_chars", "_v", "_bits", "_mean", "_codes", "_kinds")
    )


def discoveries(tests: DataFrame, discovery: float, least_random: float) -> DataFrame:
    """The random-looking tokens that Benjamini-Hochberg keeps in their class of lengths."""
    step = F.least(F.floor(F.col("nats") * BINS_PER_NAT), F.lit(MOST_NATS * BINS_PER_NAT)).cast("int")
    binned = tests.withColumn("_class", F.floor(F.log2(F.length("match"))).cast("int")).withColumn("_bin", step)
    counts = binned.groupBy("_class", "_bin").agg(F.count("*").alias("n"))  # classes x 8001 rows at most
    smallest_first = Window.partitionBy("_class").orderBy(F.desc("_bin"))
    rank = F.sum("n").over(smallest_first)
    all_of_class = F.sum("n").over(Window.partitionBy("_class"))
    limits = (
        counts.withColumn("_ok", F.exp(-F.col("_bin") / BINS_PER_NAT) <= F.lit(discovery) * rank / all_of_class)
        .where("_ok").groupBy("_class").agg(F.min("_bin").alias("_limit"))
    )
    return binned.join(F.broadcast(limits), "_class").where(  # one row per class of lengths
        (F.col("_bin") >= F.col("_limit")) & (F.col("p_random") >= least_random)
    )


def scan(
    df: DataFrame, key: str = "doc_id", text: str = "text", discovery: float = 0.01, least_random: float = 0.001
) -> DataFrame:
    """One row per input row: key and all spans `(kind, start, end)`, by start, then kind as listed."""
    t = F.coalesce(F.col(text), F.lit(""))
    hits = materialize(
        df.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(key).alias("doc_id"),
            *[found(t, PATTERNS[k], GATES[k]).alias(k) for k in PATTERNS],
            found(t, TOKEN, TOKEN).alias("random"),
        ),
        "secret-hits",
    )
    spans = materialize(located(hits), "secret-spans")
    tests = materialize(tested(uncovered(spans)).select("row", "start", "end", "match", "p_random", "nats"), "secret-tests")
    random = discoveries(tests, discovery, least_random).withColumn("kind", F.lit("random"))
    columns = ["row", "kind", "start", "end"]
    every = spans.where(F.col("kind") != "random").select(columns).unionByName(random.select(columns))
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    span = F.struct("start", order.alias("order"), "end", "kind")
    lists = every.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"))  # of one text
    none = F.array().cast(lists.schema["spans"].dataType)
    return (
        hits.select("row", "doc_id").join(lists, "row", "left")
        .select(F.col("doc_id").alias(key), F.coalesce("spans", none).alias("spans"))
    )


def _digest(spans: Column) -> Column:
    said = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(said, ",")


def secrets_query(df: DataFrame) -> DataFrame:
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return scan(df).select(
        "doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
        F.sha2(_digest(base), 256).alias("base_sha256"), _digest(F.col("spans")).alias("spans"),
    )
