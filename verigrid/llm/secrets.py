"""Secret scan with DataFrame functions only: fixed patterns, then tests of randomness.

Fixed patterns give base spans. Every other long run of key characters is a candidate: its encoding
is the smallest alphabet that holds it (separators aside where the rest has one case, as in a UUID),
and three tests ask whether its symbols could be random draws from that alphabet: chi-squared
uniformity, runs about the middle of the alphabet, and serial correlation. Fisher's method joins
them. A random-looking run is still no secret if ordinary text could look so: its p-value under text
must pass a step-up false-discovery control among all candidates of its encoding and length class in
the table. Text is a fixed model of letter pairs and of changes between lower case, upper case,
digits and separators; the p-value is the likelihood ratio of text to uniform draws times the number
of encodings, which text falls below with no more than that chance (Markov's inequality).
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verigrid.llm.common import stage

#: Base kinds in their order, with pattern and what a match must satisfy.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"(AKIA[A-Z0-9]{16,})"
HEX = r"([0-9a-f]{24,})"
#: The names of ``ASSIGN`` in lower case, shortened where one begins like another; every match has one.
ASSIGN_NAMES = ("passw", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "random")
CANDIDATE = r"([A-Za-z0-9+/_=-]{16,})"
#: Alphabets in code order.
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = {
    "hex": "0123456789abcdef", "lower": LOWER, "upper": UPPER, "base32": UPPER + "234567", "base32-lower": LOWER + "234567",
    "base36": DIGITS + LOWER, "base36-upper": DIGITS + UPPER, "letters": UPPER + LOWER, "base64": UPPER + LOWER + DIGITS + "+/-_",
}
#: All characters of a candidate, and those that may stand between the groups of a key of one case.
SEPARATORS = "+/-_="
CHARACTERS = UPPER + LOWER + DIGITS + SEPARATORS
#: Costs (decades) of letters in ordinary text: code of the character less 48 is twenty times
#: -log10 of the chance; a row for the start of a word, then one for each letter before. Counted in
#: English, French, German and Spanish words and in Python sources, mixed with 15 % uniform letters.
LETTERS = (
    "GMGJDNPPJXWLLKJJSJGHOSRXXXTNGJSXPXIXWFLDVOXDFBHUXWTXFVPU=WWXIPX?XXBUXLLUHXXXPXFXSXFWX=FXKLWX?XXNSFNXXXVXGTVO"
    "<SWV@XXOXS?XXQKPMXXXWXHVKGMSTXKXXKPASQU@DKRSXPXTGTSSEFVX>XXIWUBWXIMKIXXXQXBTUX;XOJGXXMRKMTXFIQLWXXXX@PUX<XUO"
    "GXUOVQETXNLGQUVXWVNRHNEROXXXXLM=DRXOJEXQXVXQ6XTVEXXXOXUXXXIQXXJXFUVXXXLVUQ7XQXEXXMVOSSXUESRUMXUXEXUP<XXXAXXB"
    "XWFVXXMOOXXXHXAOXV;XXXBXXSJXIEXXOUNXXXXXGSJFESCTKXTQUQJTWRG?QRXXXXRRLMUSSXLXULK=PNXBGNESOXXX@XUTAKXRKXXEXWFK"
    "XBNJOXXXNXXXXVXXXXXXVQXUXXXURX2XXXXXBTOQ<WQVFXSRORGUXJIJQUXXRXLVFTAWUIFXTPRVKLTRH>JXWXTXEWRW?XXD?XXSWXJTXFKM"
    "QXXXPPKNOT?STXNXXJLBPKXGIGXXXFXXAXVX7XXX>XXXQXMXXXVWXXXVXXBXWQEXX=BXXQVIFXXGJXXXUXXXGTGSASXXFXXOMVKBSMT@XOXR"
    "TXKRORGURSJXXKKHK>XNDDWUQXXVFQOU;XTUJWVRRXMSWSOP<XXXWU"
)
#: Chances of the next kind (lower, upper, digit, separator) by the kind before.
MOVES = {
    "start": (0.45, 0.35, 0.15, 0.05), "lower": (0.86, 0.05, 0.04, 0.05), "upper": (0.42, 0.48, 0.05, 0.05),
    "digit": (0.07, 0.07, 0.76, 0.10), "separator": (0.42, 0.15, 0.18, 0.25),
}
#: Upper-case letters are abbreviations as often as words, so half of their chance is uniform.
ABBREVIATED = 0.5
#: What a separator between groups costs at most.
SEPARATOR_COST = 2.0
SPAN = "struct<kind:int,start:int,end:int>"
BINS = 300


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def fields(**values: Column) -> Column:
    """A struct of the named values; inside ``let`` each of them is computed once."""
    return F.struct(*[value.alias(name) for name, value in values.items()])


def found(text: Column, pattern: str, group: int = 0, may: Column | None = None) -> Column:
    """All matches as (start, end, match, part); places in code points.

    What lies between matches comes from a split by the same pattern, so places are running sums.
    ``may`` is cheaper than the pattern and true for every text with a match.
    """
    kind = "array<struct<start:int,end:int,match:string,part:string>>"
    gaps = F.split(text, pattern, -1)
    whole, part = (F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(g)) for g in (1, group + 1))
    pairs = F.zip_with(F.zip_with(whole, part, lambda w, p: F.struct(w.alias("w"), p.alias("p"))), gaps,
                       lambda m, g: F.struct(m["w"].alias("w"), m["p"].alias("p"), F.length(g).alias("g")))
    pairs = F.filter(pairs, lambda x: x["w"].isNotNull())

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["g"]
        end = start + F.length(x["w"])
        one = F.struct(start.alias("start"), end.alias("end"), x["w"].alias("match"), x["p"].alias("part"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))
    places = F.aggregate(pairs, zero, step, lambda acc: acc["out"])
    matches = F.rlike(text, F.lit(pattern))
    return F.when(matches if may is None else may & matches, places).otherwise(F.array().cast(kind))


def may_assign(text: Column) -> Column:
    """True for every text that ``ASSIGN`` matches: one of its signs and, in any case, one of its names."""
    named = let(F.lower(text), lambda low: reduce(or_, (F.contains(low, F.lit(name)) for name in ASSIGN_NAMES)))
    return (F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))) & named


def base_spans(text: Column, has_run: Column) -> Column:
    """Base spans ordered by start, then kind, as (kind number, start, end).

    ``has_run`` tells whether the text has a run of ``CANDIDATE``; what ``HEX`` matches is or lies in one.
    """
    spans = []
    kinds = ((ASSIGN, 2, 6, may_assign(text)), (ACCESS, 1, 20, F.contains(text, F.lit("AKIA"))), (HEX, 1, 24, has_run))
    for number, (pattern, group, least, may) in enumerate(kinds):
        long = F.filter(found(text, pattern, group, may), _at_least(least))
        spans.append(F.transform(long, _as_span(number)))
    order = F.array_sort(F.transform(F.concat(*spans), lambda x: F.struct(x["start"], x["kind"], x["end"])))
    return F.transform(order, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))


def _at_least(n: int):
    return lambda x: F.length(x["part"]) >= n


def _as_span(kind: int):
    return lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"))


def upper_tail(z: Column) -> Column:
    """Upper tail of the normal law (logistic form, error below 0.0002), never 0."""
    held = F.greatest(F.lit(-8.0), F.least(F.lit(8.0), z))
    return let(held, lambda z: F.lit(1.0) / (F.lit(1.0) + F.exp(z * 1.5976 + z * z * z * 0.07056)))


def text_costs() -> list[int]:
    """Cost in hundredths of a decade of each of ``CHARACTERS`` after the start (row 0) or each of them."""
    kind_of = lambda c: 0 if c in LOWER else 1 if c in UPPER else 2 if c in DIGITS else 3
    kinds, out = list(MOVES.values()), []
    for before in ("", *CHARACTERS):
        first = kind_of(before) if before else -1
        for c in CHARACTERS:
            kind = kind_of(c)
            chance = 1 / (10 if kind == 2 else len(SEPARATORS))
            if kind < 2:
                # an upper-case letter after a lower-case one begins a word
                row = LOWER.index(before.lower()) + 1 if 0 <= first < 2 and (first, kind) != (0, 1) else 0
                chance = 10 ** ((48 - ord(LETTERS[26 * row + LOWER.index(c.lower())])) / 20)
                chance = chance if kind == 0 else (1 - ABBREVIATED) * chance + ABBREVIATED / 26
            out.append(round(-100 * math.log10(kinds[first + 1][kind] * chance)))
    return out


def key_of(token: Column) -> Column:
    """The token without separators where what is left is long enough and of one case, else the token."""
    bare = F.translate(token, SEPARATORS, "")
    return F.when((F.length(bare) >= 16) & F.rlike(bare, F.lit("^(?:[0-9a-z]*|[0-9A-Z]*)$")), bare).otherwise(token)


def encoding_of(key: Column) -> Column:
    """The smallest alphabet that holds the key; there is one for every candidate."""
    patterns = {
        "hex": "[0-9a-f]*|[0-9A-F]*", "lower": "[a-z]*", "upper": "[A-Z]*", "base32": "[A-Z2-7]*", "base32-lower": "[a-z2-7]*",
        "base36": "[0-9a-z]*", "base36-upper": "[0-9A-Z]*", "letters": "[A-Za-z]*",
    }
    return F.coalesce(*[F.when(F.rlike(key, F.lit(f"^(?:{p})$")), F.lit(n)) for n, p in patterns.items()], F.lit("base64"))


def randomness(codes: Column, symbols: Column) -> Column:
    """Fisher's joint p-value of the three tests for an array of symbol codes (double).

    A column that is named twice is computed twice, inside lambdas for each element; so the
    steps pass their values on in structs, and the work follows the number of codes.
    """
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda acc, x: acc + x)

    def counted(x: Column) -> Column:
        cs, symbols = x["cs"], x["symbols"]
        n = F.size(cs).cast("double")
        squares = total(F.transform(F.array_distinct(cs), lambda c: F.pow(F.size(F.filter(cs, lambda x: x == c)).cast("double"), F.lit(2.0))))
        pairs = F.zip_with(F.slice(cs, F.lit(1), F.size(cs) - 1), F.slice(cs, F.lit(2), F.size(cs) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        ones = F.size(F.filter(F.transform(cs, lambda c: c >= symbols / 2), lambda x: x)).cast("double")
        return fields(cs=cs, symbols=symbols, n=n, free=symbols - 1, squares=squares, pairs=pairs, ones=ones, mean=total(cs) / n)

    def measured(x: Column) -> Column:
        symbols, n, ones, mean = x["symbols"], x["n"], x["ones"], x["mean"]
        runs = F.size(F.filter(x["pairs"], lambda p: (p["a"] >= symbols / 2) != (p["b"] >= symbols / 2))) + F.lit(1.0)
        return fields(
            n=n, fit=F.greatest(symbols * x["squares"] / n - n, F.lit(0.0)) / x["free"], spread=F.lit(2.0) / (x["free"] * 9),
            runs=runs, mean_runs=ones * (n - ones) * 2 / n + 1,
            moved=total(F.transform(x["cs"], lambda c: (c - mean) * (c - mean))),
            along=total(F.transform(x["pairs"], lambda p: (p["a"] - mean) * (p["b"] - mean))),
        )

    def tested(x: Column) -> Column:
        n, spread, moved = x["n"], x["spread"], x["moved"]
        chi = (F.pow(x["fit"], F.lit(1 / 3)) - (F.lit(1.0) - spread)) / F.sqrt(spread)
        variance = (x["mean_runs"] - 1) * (x["mean_runs"] - 2) / (n - 1)
        runs_z = let(variance, lambda v: F.when(v > 0, F.abs(x["runs"] - x["mean_runs"]) / F.sqrt(v)).otherwise(F.lit(8.0)))
        serial = F.when(moved > 0, F.abs(x["along"] / moved + F.lit(1.0) / n) * F.sqrt(n)).otherwise(F.lit(8.0))
        return -(F.log(upper_tail(chi)) + F.log(F.least(upper_tail(runs_z) * 2, F.lit(1.0))) + F.log(F.least(upper_tail(serial) * 2, F.lit(1.0))))

    joined = lambda half: F.exp(-half) * (half + F.lit(1.0) + half * half / 2)
    return let(let(let(let(fields(cs=codes, symbols=symbols), counted), measured), tested), joined)


def text_chance(token: Column, key: Column, symbols: Column) -> Column:
    """log10 of the chance that ordinary text looks as little like text; 0 at most."""
    costs = F.split(F.lit(",".join(map(str, text_costs()))), ",").cast("array<int>")  # folded to a constant
    width = len(CHARACTERS)

    def step(acc: Column, c: Column) -> Column:
        at = F.instr(F.lit(CHARACTERS), c)
        return F.struct(at.alias("before"), (acc["cost"] + F.get(costs, acc["before"] * width + at - 1)).alias("cost"))

    zero = F.struct(F.lit(0).alias("before"), F.lit(0).cast("int").alias("cost"))
    cost = F.aggregate(F.split(token, ""), zero, step, lambda acc: acc["cost"] / 100)
    groups = F.lit(SEPARATOR_COST) * (F.length(token) - F.length(key))
    return F.least(F.lit(0.0), F.length(key) * F.log10(symbols) + groups + math.log10(len(ALPHABETS)) - cost)


def candidates(text: Column, base: Column, has_run: Column) -> Column:
    """Tested runs outside base spans: (start, end, encoding, length class, p_random, bin of p_text)."""
    runs = F.filter(found(text, CANDIDATE, 1, has_run), lambda x: ~F.exists(base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    ends = lambda x: (x["start"].alias("start"), x["end"].alias("end"))
    named = F.transform(runs, lambda x: F.struct(*ends(x), F.regexp_replace(x["match"], "=+$", "").alias("token")))
    named = F.filter(named, lambda x: F.length(x["token"]) >= 16)
    named = F.transform(named, lambda x: F.struct(*ends(x), x["token"].alias("token"), key_of(x["token"]).alias("key")))
    named = F.transform(named, lambda x: F.struct(*ends(x), x["token"].alias("token"), x["key"].alias("key"), encoding_of(x["key"]).alias("enc")))

    alphabet_of = F.create_map(*[F.lit(v) for kv in ALPHABETS.items() for v in kv])

    def test(x: Column) -> Column:
        return let(F.element_at(alphabet_of, x["enc"]), lambda alphabet: test_in(x, alphabet))

    def test_in(x: Column, alphabet: Column) -> Column:
        symbols = F.length(alphabet).cast("double")
        key = F.when(x["enc"] == "hex", F.lower(x["key"])).otherwise(x["key"])
        codes = F.transform(F.split(key, ""), lambda c: F.instr(alphabet, c).cast("double") - 0.5)
        bits = F.floor(F.log2(F.length(x["key"]).cast("double"))).cast("int")
        chance = F.floor(text_chance(x["token"], x["key"], symbols) * -10).cast("int")
        return F.struct(
            x["start"].alias("start"), x["end"].alias("end"), x["enc"].alias("enc"), bits.alias("bits"),
            randomness(codes, symbols).alias("p"), F.least(chance, F.lit(BINS)).alias("bin"),
        )

    return F.transform(named, test)


def examine(df: DataFrame) -> DataFrame:
    """Replace ``text`` by ``base`` and ``tested``; one pass over the texts."""
    text, has_run = F.coalesce(F.col("text"), F.lit("")), F.col("__has_run")
    looked = df.withColumn("__has_run", F.rlike(text, F.lit(CANDIDATE)))
    found_in = looked.withColumn("base", base_spans(text, has_run)).withColumn("tested", candidates(text, F.col("base"), has_run))
    return found_in.drop("__has_run")


def cutoffs(tested: DataFrame, rate: float, alpha: float) -> dict[tuple[str, int], int]:
    """The least bin that counts as a discovery, by encoding and length class.

    A histogram by encoding (9), length class (below 32) and bin (to ``BINS``) stands for all
    candidates, so what comes to the driver is bounded. Step-up: the largest p-value (a bin's upper
    edge) with p * tests <= rate * discoveries.
    """
    rows = tested.select(F.explode("tested").alias("t")).select("t.*")
    counts = rows.groupBy("enc", "bits", "bin").agg(F.count("*").alias("n"), F.count(F.when(F.col("p") >= alpha, 1)).alias("looks"))
    held: dict[tuple[str, int], list[tuple[int, int, int]]] = {}
    for row in counts.collect():
        held.setdefault((row["enc"], row["bits"]), []).append((row["bin"], row["n"], row["looks"]))
    out = {}
    for key, bins in held.items():
        tests, seen = sum(n for _, n, _ in bins), 0
        for number, _, looks in sorted(bins, reverse=True):
            seen += looks
            if seen and 10 ** (-number / 10) * tests <= rate * seen:
                out[key] = number
    return out


def scan(docs: DataFrame, rate: float = 0.05, alpha: float = 0.001) -> DataFrame:
    """The columns of ``docs`` but ``text``, with ``spans``: (kind number in ``KINDS``, start, end), by start, then kind.

    Places are code points, the end exclusive. A null or empty text has no spans; every row is
    examined, repeated ones too; an empty table gives no rows; columns of the added names are
    replaced. Spans of the method (kind ``random``) never meet base spans.
    """
    kept = [c for c in docs.columns if c not in ("spans", "base", "tested", "text")]
    seen = stage(examine(docs.select(*[F.col(f"`{c}`") for c in kept], "text")).drop("text"), "secrets")
    return decide(seen, rate, alpha).select(*[F.col(f"`{c}`") for c in kept], "spans")


def decide(seen: DataFrame, rate: float, alpha: float) -> DataFrame:
    limits = cutoffs(seen, rate, alpha)
    pairs = [F.lit(v) for (enc, bits), low in limits.items() for v in (f"{enc}:{bits}", low)]
    limit_of = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,int>")
    real = F.filter(
        "tested",
        lambda t: (t["p"] >= alpha) & (t["bin"] >= F.coalesce(F.try_element_at(limit_of, F.concat_ws(":", t["enc"], t["bits"].cast("string"))), F.lit(BINS + 1))),
    )
    added = F.transform(real, _as_span(KINDS.index("random")))
    spans = F.concat("base", added)
    order = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"], x["kind"], x["end"])))
    return seen.withColumn("spans", F.transform(order, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))))


def told(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    one = lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def redact(docs: DataFrame, mark: str = "[secret]", rate: float = 0.05, alpha: float = 0.001) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by a mark; spans that meet become one mark.

    Texts without spans, and null texts, stay as they are; all columns keep their place.
    """
    seen = stage(examine(docs), "secrets-text")
    marked = decide(seen, rate, alpha)
    text = F.col("text")

    def step(acc: Column, x: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, x["start"] - acc["at"])
        out = F.when(x["start"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], gap, F.lit(mark)))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), out.alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    tail = lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))
    cleaned = F.when(F.size("spans") > 0, F.aggregate("spans", zero, step, tail)).otherwise(text)
    return marked.withColumn("text", cleaned).select(*[F.col(f"`{c}`") for c in docs.columns])
