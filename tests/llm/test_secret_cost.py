"""The tests of a candidate compute each of their values once."""

import math
import random

from pyspark.sql import functions as F

from verigrid.llm import secrets


def tail(z):
    z = max(-8.0, min(8.0, z))
    return 1 / (1 + math.exp(z * 1.5976 + z**3 * 0.07056))


def p_value(codes, symbols):
    n, mean = len(codes), sum(codes) / len(codes)
    squares = sum(codes.count(c) ** 2 for c in set(codes))
    free, spread = symbols - 1, 2 / ((symbols - 1) * 9)
    fit = max(symbols * squares / n - n, 0.0) / free
    chi = (fit ** (1 / 3) - (1 - spread)) / math.sqrt(spread)
    high = [c >= symbols / 2 for c in codes]
    runs, ones = 1 + sum(a != b for a, b in zip(high, high[1:])), sum(high)
    mean_runs = ones * (n - ones) * 2 / n + 1
    variance = (mean_runs - 1) * (mean_runs - 2) / (n - 1)
    runs_z = abs(runs - mean_runs) / math.sqrt(variance) if variance > 0 else 8.0
    moved = sum((c - mean) ** 2 for c in codes)
    along = sum((a - mean) * (b - mean) for a, b in zip(codes, codes[1:]))
    serial = abs(along / moved + 1 / n) * math.sqrt(n) if moved > 0 else 8.0
    half = -(math.log(tail(chi)) + math.log(min(tail(runs_z) * 2, 1)) + math.log(min(tail(serial) * 2, 1)))
    return math.exp(-half) * (half + 1 + half * half / 2)


def test_randomness_passes_over_the_codes_a_few_times(spark):
    rng = random.Random(2)
    rows = [(i, [rng.randrange(16) + 0.5 for _ in range(16 + i)]) for i in range(40)] + [(90, [3.5] * 20), (91, [0.5, 15.5] * 12)]
    df = spark.createDataFrame(rows, "i int, codes array<double>")
    tested = df.select("i", secrets.randomness(F.col("codes"), F.lit(16.0)).alias("p"))
    # sums of counts, of codes, and of two products: one pass each, however the results are combined
    assert tested._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") == 4
    got = {r["i"]: r["p"] for r in tested.collect()}
    for i, codes in rows:
        assert math.isclose(got[i], p_value(codes, 16.0), rel_tol=1e-9), i


def test_spans_are_found_whatever_the_case_and_the_length_of_the_text(spark):
    plain = "ordinary words "
    hexed = "0123456789abcdef01234567"
    texts = {
        0: (plain * 3 + "PassWord: abc123", ["assign"]), 1: ("API_KEY=abcdef", ["assign"]), 2: ("apikey = 'abcdef'", ["assign"]),
        3: ("token abcdef", []), 4: ("a=b", []), 5: (f"é {hexed} {plain}", ["hex"]), 6: ("AKIA" + "A1" * 8 + " x", ["access"]),
        7: ("AKIA short", []), 8: ("", []), 9: (None, []), 10: (f"secret:{hexed[:6]} {hexed}", ["assign", "hex"]),
    }
    df = spark.createDataFrame([(i, t) for i, (t, _) in texts.items()], "doc_id int, text string")
    # the method's own spans never meet these
    got = {r["doc_id"]: [secrets.KINDS[s["kind"]] for s in r["spans"] if s["kind"] < 3] for r in secrets.scan(df).collect()}
    assert got == {i: kinds for i, (_, kinds) in texts.items()}


def test_redaction_examines_a_text_with_a_small_plan(spark):
    df = spark.createDataFrame([(1, "x password=abcdef1 y", "k"), (2, "plain words", "k"), (3, None, "k")], "doc_id int, text string, kept string")
    # one for the places of each of four patterns, four in the tests and one for the cost as text
    assert secrets.examine(df)._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") == 9
    got = {tuple(r) for r in secrets.redact(df).collect()}
    assert got == {(1, "x [secret] y", "k"), (2, "plain words", "k"), (3, None, "k")}
