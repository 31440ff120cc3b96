"""Secret scans: fixed patterns, and tokens that a battery of randomness tests can't tell from noise.

Fixed kinds, each matched leftmost and without overlap; a match that fails its check is dropped but still
uses up its characters:

* ``assign``: a name such as ``password`` or ``api_key``, a sign and 12 or more value characters;
* ``access``: ``AKIA`` and capitals or digits, 18 or more characters; ``hex``: 16 or more of ``0-9a-f``.

The battery adds kind ``random``. Candidates are runs of 20 or more characters of ``A-Za-z0-9+/_-``. Each
gets the narrowest encoding that holds all its characters (hex, base32, base62, base64) and three tests
over that alphabet: chi-squared for even use of the symbols, the number of runs above and below the middle
symbol, and the correlation of neighbouring symbols. Noise must pass them together (Bonferroni).

Passing says little about a short token, so a second question is put: how much better does noise explain this
token than an *ordinary* one, made of words, names and numbers? Ordinary tokens are a Markov chain over the
symbols: chances to change between lower case, capitals, digits and signs, and the pairs of letters in words.
With the likelihood ratio R of noise to that chain, ordinary tokens reach R or more with a chance of at most
1 / R (Markov's inequality), at any length; 20 characters of noise mostly have an R above 10,000.
These probabilities go into Benjamini-Hochberg control at ``false_share``, one family per encoding and
power of two of the length, over all tokens of the table. Families are counted in bins of the logarithm,
so the control needs a small table of counts, whatever the size of the input.

Defined results: a null or empty text has no spans; a lower-case hex run is reported as ``hex`` only; random
spans may overlap fixed ones; positions are code points, end exclusive; every input row gives a row,
repeated or without an id; an empty table gives an empty result. Only DataFrame functions are used.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import stored

# The patterns of the scan.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
KINDS = ("assign", "access", "hex", "random")
MIN_VALUE = 12


@dataclass(frozen=True)
class Encoding:
    """``changes``: in ordinary tokens, the chances of the class of the next symbol after each class."""

    name: str
    accepts: str
    alphabet: str
    changes: dict[str, dict[str, float]]


_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
# Narrowest first. An ordinary hex token is a number; the others are words and names.
ENCODINGS = (
    Encoding(
        "hex",
        "^([0-9A-F]+|[0-9a-f]+)$",
        _DIGITS + "abcdef",
        {"digit": {"digit": 0.995, "lower": 0.005}, "lower": {"digit": 0.1, "lower": 0.9}},
    ),
    Encoding(
        "base32",
        "^[A-Z2-7]+$",
        _UPPER + "234567",
        {"upper": {"upper": 0.97, "digit": 0.03}, "digit": {"upper": 0.15, "digit": 0.85}},
    ),
    Encoding(
        "base62",
        "^[A-Za-z0-9]+$",
        _DIGITS + _UPPER + _LOWER,
        {
            "lower": {"lower": 0.93, "upper": 0.05, "digit": 0.02},
            "upper": {"lower": 0.38, "upper": 0.57, "digit": 0.05},
            "digit": {"lower": 0.1, "upper": 0.1, "digit": 0.8},
        },
    ),
    Encoding(
        "base64",
        "",
        _UPPER + _LOWER + _DIGITS + "+/",
        {
            "lower": {"lower": 0.83, "upper": 0.03, "digit": 0.02, "sign": 0.12},
            "upper": {"lower": 0.33, "upper": 0.55, "digit": 0.04, "sign": 0.08},
            "digit": {"lower": 0.1, "upper": 0.05, "digit": 0.7, "sign": 0.15},
            "sign": {"lower": 0.75, "upper": 0.12, "digit": 0.11, "sign": 0.02},
        },
    ),
)
# Pairs of letters in words: a row for each letter and one for the start of a word, a place for the letter after
# it, in quarters of a bit as digits to base 36. Counted over the identifiers and comments of Python's standard
# library and the pieces of the public vocabulary (several languages); a tenth of each row is spread evenly.
PAIRS = (
    "ligitqktjvodhevjvcfbnoqpnt",
    "ckindpssfjtbpqfnuhiofuuujs",
    "dsmodrtdivfhosaruindjsuvpv",
    "fnnj7nqtauujrpfqujhmirstpv",
    "iqgemkotqvthjdrlobcfsnpiqv",
    "fqnlfcou9uvhqncqugkjhutuow",
    "hspq7qkgfvuinhjqvefniquvsr",
    "arrp8suscvsnoobsviohkuuvou",
    "kmgjjljvtusgi8flvkfevlvpwm",
    "dqmp9trqishrtqbmsqiqavrrrt",
    "hqnl7olqdttgsjmosmdlnsjunv",
    "drpk9nttbvterqdowsjjjruvht",
    "ajtp8suuevsmjqedwtjnjuvwov",
    "fsgedlcshuoosmgpusfbmnuvrv",
    "plhgrnntovnhgajhwciigmjqtu",
    "bsoobqsmgwsetrehtckgkusvkw",
    "mqpqrtrqpuvnrmromjjs2rqrtt",
    "drll9pludwpnklepwjgglprvlv",
    "ktiqarqievompqiisre9gtqumv",
    "esmo9pufbwtnprgnvehjktqtkt",
    "jhjmglmvjvuegbpgwdedttvtvu",
    "9pqs5rsscuurosirvqpqssrutu",
    "bqoldptgauumrgeqwfgprrmptv",
    "hlekeitnftumkrocupmarrsfjs",
    "lnjmhorriusjhfkbumddrolpem",
    "fsqn6qsqdvvomrhrtqprqupona",
    "gjfhhiklgrpjijjgrhehkolpss",
)
# Bins per natural logarithm of a probability, and how far they reach.
BINS_PER_UNIT, LEAST_LOG = 20, 60


def _normal_tail(x: Column) -> Column:
    """P(Z > x): the rational approximation 26.2.17 of Abramowitz and Stegun, by symmetry for x < 0."""
    a = F.abs(x)
    t = 1 / (1 + 0.2316419 * a)
    poly = reduce(lambda s, c: (s + c) * t, (1.330274429, -1.821255978, 1.781477937, -0.356563782, 0.319381530), F.lit(0.0))
    tail = F.exp(-a * a / 2) / 2.5066282746310002 * poly
    return F.when(x >= 0, tail).otherwise(1 - tail)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, for use inside other lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(lengths: Column) -> Column:
    """Sums of the lengths before each place. Blocks of 256 keep the work per place bounded."""
    block = 256
    count = F.greatest(F.ceil(F.size(lengths) / block).cast("int"), F.lit(1))
    blocks = F.transform(F.sequence(F.lit(0), count - 1), lambda k: F.slice(lengths, k * block + 1, block))
    zero = F.array(F.lit(0).cast("long"))
    add = lambda sums, x: F.concat(sums, F.array(F.element_at(sums, -1) + x))
    inner = F.transform(blocks, lambda b: F.aggregate(b, zero, add))
    starts = F.aggregate(inner, zero, lambda sums, b: add(sums, F.element_at(b, -1)))
    shifted = F.zip_with(inner, F.slice(starts, 1, count), lambda b, s: F.transform(b, lambda x: x + s))
    return F.flatten(F.transform(shifted, lambda b: F.slice(b, 1, F.size(b) - 1)))


def matches(text: Column, pattern: str) -> Column:
    """All matches as ``start, end, text``: the text is parted at the matches and the lengths are summed."""

    def placed(found: Column) -> Column:
        gaps = F.slice(F.transform(F.split(text, pattern, -1), lambda x: F.length(x).cast("long")), 1, F.size(found))
        lengths = F.flatten(F.zip_with(gaps, found, lambda g, m: F.array(g, F.length(m).cast("long"))))
        with_end = F.concat(lengths, F.array(F.lit(0).cast("long")))
        return _let(_let(with_end, _running), lambda sums: F.transform(found, lambda m, i: span(m, i, sums)))

    def span(m: Column, i: Column, sums: Column) -> Column:
        return F.struct(F.element_at(sums, 2 * i + 2).alias("start"), F.element_at(sums, 2 * i + 3).alias("end"), m.alias("text"))

    none = F.array().cast("array<struct<start:bigint,end:bigint,text:string>>")
    every = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return _let(every, lambda found: F.when(F.size(found) > 0, placed(found)).otherwise(none))


def _tests(token: Column, e: Encoding) -> Column:
    """``n, p_random, p_ordinary`` of a token in a given encoding."""
    clean = F.lower(token) if e.name == "hex" else F.translate(token, "-_", "+/")
    k = float(len(e.alphabet))
    symbols = F.filter(F.split(clean, "", -1), lambda c: F.length(c) > 0)
    values = F.transform(symbols, lambda c: F.instr(F.lit(e.alphabet), c) - F.lit(1.0))
    squares = reduce(lambda s, c: s + F.pow(F.length(clean) - F.length(F.translate(clean, c, "")), F.lit(2.0)), e.alphabet, F.lit(0.0))
    steps = lambda v: F.zip_with(F.slice(v, 1, F.size(v) - 1), F.slice(v, 2, F.size(v) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    change = lambda s, x: s + F.when((x["a"] >= k / 2) != (x["b"] >= k / 2), 1.0).otherwise(0.0)
    middle = (k - 1) / 2
    gains = F.split(F.lit(",".join(f"{x:.3f}" for x in noise_gains(e))), ",").cast("array<double>")
    gain = lambda s, x: s + F.element_at(gains, (x["a"] * k + x["b"] + 1).cast("int"))
    sums = lambda v: F.struct(
        F.size(v).cast("double").alias("n"),
        squares.alias("squares"),
        F.aggregate(v, F.lit(0.0), lambda s, x: s + F.when(x >= k / 2, 1.0).otherwise(0.0)).alias("high"),
        F.aggregate(steps(v), F.lit(0.0), change).alias("changes"),
        F.aggregate(steps(v), F.lit(0.0), lambda s, x: s + (x["a"] - middle) * (x["b"] - middle)).alias("product"),
        F.aggregate(steps(v), F.lit(0.0), gain).alias("gain"),
    )
    return _let(_let(values, sums), lambda m: _probabilities(m, k))


def _probabilities(m: Column, k: float) -> Column:
    n = m["n"]
    # Chi-squared for even use, made normal by the cube root (Wilson and Hilferty).
    part = 2 / (9 * (k - 1))
    chi = k / n * m["squares"] - n
    p_even = _normal_tail((F.pow(chi / (k - 1), F.lit(1 / 3)) - (1 - part)) / part**0.5)
    # Runs above and below the middle symbol (Wald and Wolfowitz).
    both = 2 * m["high"] * (n - m["high"])
    variance = both * (both - n) / (n * n * (n - 1))
    p_runs = F.when(variance > 0, 2 * _normal_tail(F.abs(m["changes"] - both / n) / F.sqrt(variance))).otherwise(0.0)
    # Correlation of neighbouring symbols around the middle of the alphabet.
    p_serial = 2 * _normal_tail(F.abs(m["product"]) / ((k * k - 1) / 12) / F.sqrt(n - 1))
    return F.struct(
        n.cast("long").alias("n"),
        F.least(3 * F.least(p_even, p_runs, p_serial), F.lit(1.0)).alias("p_random"),
        F.exp(-F.greatest(m["gain"], F.lit(0.0))).alias("p_ordinary"),
    )


def _class(symbol: str) -> str:
    return "lower" if symbol in _LOWER else "upper" if symbol in _UPPER else "digit" if symbol in _DIGITS else "sign"


def noise_gains(e: Encoding) -> list[float]:
    """For each pair of symbols, the logarithm of how much likelier noise has the second after the first."""
    k = len(e.alphabet)
    shares = []
    for row in PAIRS:
        raw = [2 ** (-int(c, 36) / 4) for c in row]
        shares.append([x / sum(raw) for x in raw])
    sizes = Counter(map(_class, e.alphabet))

    def ordinary(a: str, b: str) -> float:
        one, two = _class(a), _class(b)
        if e.name == "hex" or two in ("digit", "sign"):
            return e.changes[one][two] / sizes[two]
        # A capital after a lower-case letter starts a word, as does a letter after a digit or sign.
        inside = one in ("lower", "upper") and (one, two) != ("lower", "upper")
        row = shares[_LOWER.index(a.lower()) if inside else -1]
        return e.changes[one][two] * row[_LOWER.index(b.lower())]

    return [-math.log(k * ordinary(a, b)) for a in e.alphabet for b in e.alphabet]


def battery(token: Column) -> Column:
    """``encoding, n, p_random, p_ordinary`` of a token.

    ``p_random``: Bonferroni over the three tests of noise. ``p_ordinary``: a bound of the chance that an ordinary
    token looks at least as much like noise.
    """
    named = lambda e: F.struct(F.lit(e.name).alias("encoding"), _tests(token, e).alias("p"))
    out = named(ENCODINGS[-1])
    for e in reversed(ENCODINGS[:-1]):
        out = F.when(token.rlike(e.accepts), named(e)).otherwise(out)
    return out


def _family(tested: Column) -> Column:
    """Encoding, power of two of the length, and bin. A bin counts at its largest probability: a cautious bound."""
    log = F.least(-F.log(F.greatest(tested["p"]["p_ordinary"], F.lit(1e-300))), F.lit(float(LEAST_LOG)))
    return F.struct(
        tested["encoding"].alias("encoding"),
        F.floor(F.log2(tested["p"]["n"].cast("double"))).cast("int").alias("octave"),
        F.floor(log * BINS_PER_UNIT).cast("int").alias("bin"),
    )


def discoveries(tested: DataFrame, false_share: float) -> dict[tuple[str, int], int]:
    """For each family, the first bin whose tokens count as discoveries (Benjamini and Hochberg).

    ``tested`` has a column ``family``. Its counts have at most one row for each encoding, power of two and
    bin, so they may come to the driver.
    """
    families: dict[tuple[str, int], dict[int, int]] = {}
    for family, n in tested.groupBy("family").count().collect():
        families.setdefault((family["encoding"], family["octave"]), {})[family["bin"]] = n
    found = {}
    for name, counts in families.items():
        every, seen = sum(counts.values()), 0
        for b in sorted(counts, reverse=True):
            seen += counts[b]
            if math.exp(-b / BINS_PER_UNIT) <= false_share * seen / every:
                found[name] = b
    return found


def scan_secrets(
    docs: DataFrame, text_col: str = "text", carry: list[str] | None = None, false_share: float = 0.01, min_random: float = 0.01
) -> DataFrame:
    """One row per input row: ``row``, then ``assign``, ``access``, ``hex``, ``random``, each an array of spans.

    A span is ``start, end``. ``carry`` limits ``row`` to these columns, so that texts are not written again.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    value = lambda m: F.length(F.regexp_extract(m["text"], ASSIGN, 2)) >= MIN_VALUE
    plain = lambda c: F.transform(c, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end")))
    tokens = F.filter(matches(text, CANDIDATE), lambda m: ~m["text"].rlike("^[0-9a-f]+$"))
    tested = F.transform(
        tokens,
        lambda m: _let(
            battery(m["text"]),
            lambda t: F.struct(
                m["start"].alias("start"), m["end"].alias("end"), t["p"]["p_random"].alias("p_random"), _family(t).alias("family")
            ),
        ),
    )
    found = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns]).alias("row"),
        plain(F.filter(matches(text, ASSIGN), value)).alias("assign"),
        plain(matches(text, ACCESS)).alias("access"),
        plain(matches(text, HEX)).alias("hex"),
        tested.alias("tokens"),
    )
    found = stored(found, "secret-spans")
    limits = discoveries(found.select(F.explode("tokens.family").alias("family")), false_share)

    def secret(m: Column) -> Column:
        # Families are bounded by encodings times powers of two of the length.
        is_found = F.lit(False)
        for (encoding, octave), first in limits.items():
            same = (m["family"]["encoding"] == encoding) & (m["family"]["octave"] == octave)
            is_found = is_found | (same & (m["family"]["bin"] >= first))
        return is_found & (m["p_random"] >= min_random)

    return found.select("row", "assign", "access", "hex", plain(F.filter("tokens", secret)).alias("random"))


def listed(*kinds: str) -> Column:
    """The spans of the kinds as ``kind:start:end``, by start and then in the order given, comma-joined."""

    def marked(place: int, kind: str) -> Column:
        return F.transform(
            kind, lambda s: F.struct(s["start"].alias("start"), F.lit(place).alias("place"), s["end"].alias("end"), F.lit(kind).alias("kind"))
        )

    ordered = F.array_sort(F.concat(*[marked(place, kind) for place, kind in enumerate(kinds)]))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
