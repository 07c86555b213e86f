"""Secret scan: fixed patterns, and a randomness battery over encoded-looking tokens.

The battery asks of every token whether its characters look uniformly and independently drawn from the alphabet of the
encoding it seems to have. Each test is an equivalence test: its null hypothesis is a departure from randomness of at
least a stated size per character, so a small p-value is evidence of randomness. Text departs in two ways, in uneven
characters and in few changes between digits, small and capital letters; the deviates of these two make one, since neither
can convict a short token. The runs and serial-correlation tests of order have to be passed besides: the greatest of the three
counts. Within each family of one encoding and
one band of lengths the Benjamini-Hochberg rule over all tokens of the corpus then decides which are reported.
Everything runs on DataFrame functions; the rule needs only a histogram of log p-values, of fixed size, per family.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from faremill.llm.quality_rules import let
from faremill.llm.store import saved

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
#: Least lengths: of group 2 of an assignment, of an access key, of a hexadecimal run, of a token for the battery.
ASSIGN_VALUE, ACCESS_KEY, HEX_RUN, TOKEN = 12, 18, 16, 20
TOKEN_PATTERN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+"
KINDS = ("assign", "access", "hex", "random")

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings in the order they are tried; the first whose alphabet holds every character is the inferred one. Tokens
#: without a digit have families of their own, so that words and slugs do not outnumber the others.
LETTERS_ONLY = {
    "lower": _LOWER,
    "upper": _UPPER,
    "letters": _LOWER + _UPPER,
    "letters64": _UPPER + _LOWER + "+/",
    "letters64url": _UPPER + _LOWER + "-_",
}
ALPHABETS = LETTERS_ONLY | {
    "hex": _DIGITS + "abcdef",
    "HEX": _DIGITS + "ABCDEF",
    "base32": _UPPER + "234567",
    "lower36": _DIGITS + _LOWER,
    "upper36": _DIGITS + _UPPER,
    "base62": _DIGITS + _LOWER + _UPPER,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
}
#: Lengths at which a new band of a family begins.
BANDS = (32, 48, 96)
#: Departures that count as not random: in evenness half of what running text has, whose letters' squared shares sum to
#: LANGUAGE (hexadecimal digits are no text); in changes of class these shares of what random characters have, with
#: digits in the alphabet and without; in order so many standard deviations per root of the length.
LANGUAGE, UNEVEN_HEX, CHANGES, DRIFT = 0.065, 1.5, (0.6, 0.7), 0.8
CLASSES = (_DIGITS, _LOWER, _UPPER, "+/-_")
CLASS_RUN = "[0-9]+|[a-z]+|[A-Z]+|[+/_-]+"
FALSE_DISCOVERY = 0.05
#: Bins of p-values per power of ten, and the powers that they reach down to.
BINS, POWERS = 100, 300


def running(lengths: Column, block: int = 64) -> Column:
    """Sums of all earlier elements, for every element; in blocks, so that long arrays stay far from quadratic."""
    zero = F.lit(0).cast("long")
    add = lambda total, x: total + x

    def by_blocks(values: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(values) - 1) / block).cast("int")),
            lambda b: F.slice(values, b * block + 1, F.lit(block)),
        )

        def inside(parts: Column) -> Column:
            sums = F.transform(parts, lambda part: F.aggregate(part, zero, add))
            return let(
                sums,
                lambda totals: F.flatten(
                    F.transform(
                        parts,
                        lambda part, b: let(
                            F.aggregate(F.slice(totals, F.lit(1), b), zero, add),
                            lambda before: F.transform(
                                part, lambda _, i: before + F.aggregate(F.slice(part, F.lit(1), i), zero, add)
                            ),
                        ),
                    )
                ),
            )

        return let(blocks, inside)

    return F.when(F.size(lengths) > 0, let(lengths, by_blocks)).otherwise(F.array().cast("array<bigint>"))


def _none() -> Column:
    return F.array().cast("array<struct<text:string,value:string,start:bigint,end:bigint>>")


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """text, value (of the group), start and end (code points) of the leftmost non-overlapping matches."""

    def placed(found: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), lambda gap: F.length(gap).cast("long"))
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        # Before match i stand the gaps up to i and the matches before i.
        steps = F.zip_with(gaps, found, lambda gap, match: gap + F.coalesce(F.length(match), F.lit(0)))

        def spans(before: Column, gap: Column, value: Column) -> Column:
            def one(match: Column, i: Column) -> Column:
                start = F.get(before, i) + F.get(gap, i)
                return F.struct(
                    match.alias("text"), F.get(value, i).alias("value"), start.alias("start"), (start + F.length(match)).alias("end")
                )

            return F.transform(found, one)

        return let(running(steps), lambda before: let(gaps, lambda gap: let(values, lambda value: spans(before, gap, value))))

    return F.when(text.rlike(pattern), let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)).otherwise(_none())


def powers_below(z: Column) -> Column:
    """-log10 of the standard normal distribution function.

    Down to z = -4 by Abramowitz and Stegun 26.2.17, to 1e-7; below by the asymptotic series of the tail, which does not
    underflow and is right to a fifth of a percent.
    """
    x = F.abs(z)

    def tail() -> Column:
        t = 1 / (1 + 0.2316419 * x)
        poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
        return F.exp(-x * x / 2) * poly * 0.3989422804014327

    far = F.greatest(x, F.lit(4.0))
    step = 1 / (far * far)
    series = 1 - step * (1 - 3 * step * (1 - 5 * step * (1 - 7 * step)))
    beyond = far * far / 2 + F.log(far) + 0.9189385332046727 - F.log(series)
    return F.when(z > 0, -F.log10(1 - tail())).when(z > -4, -F.log10(tail())).otherwise(beyond / 2.302585092994046)


def bin_of(z: Column) -> Column:
    """The bin of a p-value, rounded up: 0 for 1, BINS more for each power of ten below."""
    return F.least(F.floor(powers_below(z) * BINS), F.lit(BINS * POWERS)).cast("int")


def encoding(token: Column) -> Column:
    """The inferred encoding; null for tokens without a letter, which are numbers."""
    chosen = None
    for name, alphabet in ALPHABETS.items():
        fits = token.rlike("^[" + alphabet.replace("-", r"\-") + "]+$")
        chosen = F.when(fits, F.lit(name)) if chosen is None else chosen.when(fits, F.lit(name))
    return F.when(token.rlike("[A-Za-z]"), chosen)


def _null_changes(alphabet: str) -> float:
    """The chance of a change of class between neighbours up to which a token may be text; 0 for a single class."""
    shares = [sum(c in kind for c in alphabet) / len(alphabet) for kind in CLASSES]
    return CHANGES[shares[0] == 0] * (1 - sum(x * x for x in shares))


def deviate(token: Column, alphabet: Column) -> Column:
    """The normal deviate of all tests together against a departure from randomness."""
    n, size = F.length(token).cast("double"), F.length(alphabet).cast("double")
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda a, x: a + x)

    def squares() -> Column:
        counts = F.transform(F.split(alphabet, ""), lambda c: n - F.length(F.replace(token, c, F.lit(""))))
        return total(F.transform(counts, lambda k: k * k))

    chi = size / n * squares() - n
    offset = n * F.when(size <= 16, F.lit(UNEVEN_HEX)).otherwise((LANGUAGE * size - 1) / 2)
    even = (chi - (size - 1 + offset)) / F.sqrt(2 * (size - 1 + 2 * offset))

    def runs(v: Column) -> Column:
        high = F.transform(v, lambda x: (x > (size - 1) / 2).cast("int"))

        def z(b: Column) -> Column:
            ones = F.aggregate(b, F.lit(0), lambda a, x: a + x).cast("double")
            changes = F.aggregate(
                F.transform(b, lambda x, i: F.coalesce((x != F.get(b, i + 1)).cast("int"), F.lit(0))), F.lit(0), lambda a, x: a + x
            )
            mean = 2 * ones * (n - ones) / n
            spread = F.sqrt(mean * (mean - 1) / (n - 1))
            return F.when(mean > 1, F.abs(changes - mean) / spread).otherwise(n)

        return let(high, z) - DRIFT * F.sqrt(n)

    def serial(v: Column) -> Column:
        def correlation(mean: Column) -> Column:
            apart = F.transform(v, lambda x: x - mean)

            def r(d: Column) -> Column:
                around = total(F.transform(d, lambda x: x * x))
                along = total(F.transform(d, lambda x, i: x * F.coalesce(F.get(d, i + 1), F.lit(0.0))))
                return F.when(around > 0, along / around).otherwise(F.lit(1.0))

            return let(apart, r)

        found = let(total(v) / n, correlation)
        return (F.abs(found + 1 / n) - DRIFT) * F.sqrt(n)

    values = F.transform(F.split(token, ""), lambda c: (F.instr(alphabet, c) - 1).cast("double"))
    rates = F.create_map(*(F.lit(x) for letters in ALPHABETS.values() for x in (letters, _null_changes(letters))))

    def against_text(rate: Column) -> Column:
        changes = F.regexp_count(token, F.lit(CLASS_RUN)) - 1
        few = ((n - 1) * rate - changes) / F.sqrt((n - 1) * rate * (1 - rate))
        return F.when(rate > 0, (even + few) / F.sqrt(F.lit(2.0))).otherwise(even)

    text = let(F.element_at(rates, alphabet), against_text)
    return F.greatest(text, let(values, lambda v: F.greatest(runs(v), serial(v))))


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns, by start, then kind."""

    def spans(kind: str, found: Column) -> Column:
        rank = F.lit(KINDS.index(kind))
        return F.transform(
            found, lambda m: F.struct(m["start"].alias("start"), rank.alias("rank"), m["end"].alias("end"))
        )

    assign = F.filter(matches(text, ASSIGN, 2), lambda m: F.length(m["value"]) >= ASSIGN_VALUE)
    # A run of the alphabet is found whole, so a least length in the pattern drops exactly the shorter runs.
    access = matches(text, ACCESS.replace("+", f"{{{ACCESS_KEY - 4},}}"))
    hexes = matches(text, HEX.replace("+", f"{{{HEX_RUN},}}"))
    return F.sort_array(F.concat(spans("assign", assign), spans("access", access), spans("hex", hexes)))


def tested_tokens(text: Column) -> Column:
    """Start, end, family and bin of the p-value of every token that looks encoded."""
    names = F.create_map(*(F.lit(x) for pair in ALPHABETS.items() for x in pair))

    def tested(m: Column, code: Column) -> Column:
        band = sum((F.length(m["text"]) >= edge).cast("int") for edge in BANDS)
        # Bound once: inside the lambdas over characters it would be found anew for every character.
        z = let(F.element_at(names, code), lambda alphabet: deviate(m["text"], alphabet))
        return F.struct(
            m["start"].alias("start"),
            m["end"].alias("end"),
            F.concat_ws(":", code, band.cast("string")).alias("family"),
            let(z, bin_of).alias("bin"),
        )

    known = lambda m: let(encoding(m["text"]), lambda code: F.when(code.isNotNull(), tested(m, code)))
    return F.filter(F.transform(matches(text, TOKEN_PATTERN), known), lambda t: t.isNotNull())


def limits(tokens: DataFrame, alpha: float = FALSE_DISCOVERY) -> DataFrame:
    """One row: by family, the bin of the greatest p-values that the Benjamini-Hochberg rule accepts."""
    counts = tokens.groupBy("family", "bin").agg(F.count("*").alias("n"))
    family = Window.partitionBy("family")
    up_to = F.sum("n").over(family.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = counts.select("family", "bin", up_to.alias("rank"), F.sum("n").over(family).alias("all"))
    taken = ranked.where(F.pow(F.lit(10.0), -F.col("bin") / BINS) <= alpha * F.col("rank") / F.col("all"))
    each = taken.groupBy("family").agg(F.min("bin").alias("bin"))
    return each.agg(F.map_from_entries(F.collect_list(F.struct("family", "bin"))).alias("limits"))


def all_spans(base: Column, tokens: Column, accepted: Column) -> Column:
    """Base spans and the tokens in an accepted bin that lie inside none of them, by start, then kind."""
    rank = F.lit(KINDS.index("random"))
    kept = F.filter(
        tokens,
        lambda t: (t["bin"] >= F.try_element_at(accepted, t["family"]))
        & ~F.exists(base, lambda s: (s["start"] <= t["start"]) & (s["end"] >= t["end"])),
    )
    reported = F.transform(kept, lambda t: F.struct(t["start"].alias("start"), rank.alias("rank"), t["end"].alias("end")))
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint>>")
    return F.sort_array(F.concat(base, F.when(F.size(tokens) > 0, reported).otherwise(none)))


def find_secrets(docs: DataFrame, alpha: float = FALSE_DISCOVERY) -> DataFrame:
    """doc_id, base and spans of every row of ``docs`` (doc_id, text).

    base: spans of the fixed patterns; spans: those and the tokens that the battery reports, without tokens that lie
    inside a base span. A span is (start, rank, end): code points, end exclusive; rank is the place in KINDS. Both are
    ordered by start, then kind. Null and empty texts have none. Repeated rows are scanned each, and each counts
    in the false-discovery rule. Other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    scanned = saved(docs.select("doc_id", base_spans(text).alias("base"), tested_tokens(text).alias("tokens")), "scanned")
    found = limits(scanned.select(F.explode("tokens").alias("t")).select("t.*"), alpha)
    joined = scanned.withColumn("limits", found.scalar())
    return joined.select("doc_id", "base", all_spans(F.col("base"), F.col("tokens"), F.col("limits")).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts per kind, the base spans' SHA-256 and all spans as text."""
    kinds = F.array(*(F.lit(k) for k in KINDS))

    def joined(spans: str) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))),
            ",",
        )

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["rank"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(count(kind) for kind in KINDS[:3]),
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
        count("random"),
    )


def masked(text: Column, spans: Column, mask: str) -> Column:
    """``text`` with every span, or run of overlapping spans, replaced by ``mask``."""

    def cut(state: Column, span: Column) -> Column:
        fresh = span["start"] >= state["at"]
        kept = F.substring(text, (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int"))
        return F.struct(
            F.greatest(span["end"], state["at"]).alias("at"),
            F.when(fresh, F.concat(state["out"], F.array(kept, F.lit(mask)))).otherwise(state["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    rest = lambda s: F.substring(text, (s["at"] + 1).cast("int"), F.length(text))
    return F.aggregate(spans, start, cut, lambda s: F.concat(F.array_join(s["out"], ""), rest(s)))


def redacted(docs: DataFrame, mask: str = "[SECRET]", alpha: float = FALSE_DISCOVERY) -> DataFrame:
    """``docs`` with every span of its texts replaced by ``mask`` and n_chars, where there is one, counted anew.

    Overlapping spans become one mask. Rows without a span stay as they are, null texts included. The limits of the battery
    come from a first pass over the tokens; the second pass finds and masks row by row, so no text is shuffled.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = limits(docs.select(F.explode(tested_tokens(text)).alias("t")).select("t.*"), alpha)
    own = "found"
    while own in docs.columns:
        own = f"_{own}"
    parts = F.struct(base_spans(text).alias("base"), tested_tokens(text).alias("tokens"))
    scanned = docs.withColumn(own, parts).withColumn(f"{own}_limits", saved(found, "limits").scalar())
    spans = all_spans(F.col(f"{own}.base"), F.col(f"{own}.tokens"), F.col(f"{own}_limits"))
    scanned = scanned.withColumn(own, spans).drop(f"{own}_limits")
    some = F.size(own) > 0
    changed = {"text": F.when(some, masked(F.col("text"), F.col(own), mask)).otherwise(F.col("text")).alias("text")}
    scanned = scanned.select(*(changed.get(c, F.col(c)) for c in docs.columns), some.alias(own))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        count = F.when(F.col(own), F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        scanned = scanned.withColumn("n_chars", count)
    return scanned.select(*docs.columns)
