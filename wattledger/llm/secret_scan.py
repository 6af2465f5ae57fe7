"""Secret scans: patterns of known secrets, and windows of high entropy in candidate strings.

Positions come from the regular expressions themselves: splitting a text at a pattern gives the
gaps, the gaps and the matches give the starts. A candidate string is a long run of key characters;
a window slides over it and keeps the counts of its characters, one leaving and one entering, with
the entropy following from the running sum of c * log2(c). Its limit depends on the character class
of the candidate. Strings on the allow-list and strings that lie within a pattern's span add nothing.

Nothing takes quadratic time in the length of a string or the number of hits: candidates are cut
into parts that overlap by less than a window, and running sums and maxima go over parts of an array.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.functions.once import with_computed
from wattledger.llm.common import boxed, unboxed

# Patterns of the base kinds, in the order in which equal starts are listed.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_mixed")

#: Length of the sliding window and the bits per character that flag it, by character class.
WINDOW = 20
HEX_BITS = 3.0
MIXED_BITS = 3.7
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}"

#: Strings that are not secrets: plain words, digits, identifiers of words, UUIDs, path-like words.
ALLOWED = (
    r"^[A-Za-z]+$",
    r"^[0-9]+$",
    r"^[A-Za-z]+([_/=-]+[A-Za-z]+)*[_/=-]*$",
    r"^[0-9]+([_/=+-]+[0-9]+)*$",
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
)

SPAN = "array<struct<start:int,kind:int,stop:int>>"
#: Above every position; candidates are sorted behind the spans that begin where they do.
END_OF_ORDER = 2**31 - 1
#: Characters of a candidate, and elements of an array, that are handled as one part.
STRING_PART = 4096
ARRAY_PART = 256

#: Counts of a window: five bits per character, twelve characters in a bigint; candidates consist
#: of ASCII characters from "+" to "z".
FIRST_CODE = ord("+")
COUNT_BITS = 5
PER_LONG = 12
LONGS = -(-(ord("z") - FIRST_CODE + 1) // PER_LONG)


def _hits(text: Column, pattern: str) -> Column:
    """Gap before each match and the match itself."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    return F.when(
        text.rlike(pattern),
        F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, m: F.struct(F.length(g).alias("gap"), m.alias("m"))),
    ).otherwise(F.array().cast("array<struct<gap:int,m:string>>"))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _cut(values: Column) -> Column:
    """An array (a column or bound) in parts of ARRAY_PART elements."""
    n = F.ceil(F.size(values) / ARRAY_PART).cast("int")
    starts = F.filter(F.sequence(F.lit(0), n), lambda j: j < n)
    return F.transform(starts, lambda j: F.slice(values, j * ARRAY_PART + 1, ARRAY_PART))


def running(values: Column, add: Callable[[Column, Column], Column]) -> Column:
    """`add` of the values up to each element of an array of int, 0 before the first."""

    def grow(part: Column) -> Column:
        # An element longer than `part`: it begins with 0.
        return F.aggregate(part, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(add(F.element_at(a, -1), x))))

    def together(within: Column) -> Column:
        ends = grow(F.transform(within, lambda w: F.element_at(w, -1)))
        return F.flatten(
            F.zip_with(
                within,
                F.slice(ends, F.lit(1), F.size(within)),
                lambda w, before: F.transform(F.slice(w, F.lit(2), F.size(w) - 1), lambda x: add(before, x)),
            )
        )

    return bound(values, lambda v: bound(F.transform(_cut(v), grow), together))


def _placed(hits: Column) -> Column:
    """Start and text of each match, in code points."""
    ends = running(F.transform(hits, lambda x: x["gap"] + F.length(x["m"])), lambda a, x: a + x)
    return F.zip_with(
        hits, ends, lambda x, end: F.struct((end - F.length(x["m"])).alias("start"), x["m"].alias("m"))
    )


def _spans(placed: Column, kind: int) -> Column:
    return F.transform(
        placed,
        lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), (x["start"] + F.length(x["m"])).alias("stop")),
    )


def _least_sum(places: Column, window: int) -> Column:
    """Least sum of c * log2(c) over the counts c of any window.

    `places` (a bound array) says in which bigint and at which bit each character is counted.
    """
    weight = [c * math.log2(c) if c > 1 else 0.0 for c in range(window + 1)]
    # What the c-th of equal characters adds.
    step = F.array(F.lit(0.0), *(F.lit(weight[c] - weight[c - 1]) for c in range(1, window + 1)))

    def count(counts: Column, x: Column) -> Column:
        mask = F.lit((1 << COUNT_BITS) - 1).cast("long")
        return F.call_function("shiftrightunsigned", F.get(counts, x["long"]), x["at"]).bitwiseAND(mask).cast("int")

    def one(x: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), x["at"])

    def state(total: Column, counts: Column, least: Column) -> Column:
        return F.struct(total.alias("sum"), counts.alias("counts"), least.alias("least"))

    def enter(a: Column, x: Column) -> Column:
        counts = F.transform(a["counts"], lambda c, j: F.when(j == x["long"], c + one(x)).otherwise(c))
        return state(a["sum"] + F.get(step, count(a["counts"], x) + 1), counts, a["least"])

    def slide(a: Column, i: Column) -> Column:
        gone, new = F.get(places, i - window), F.get(places, i)
        same = gone == new

        def other(c: Column, j: Column) -> Column:
            less = F.when(j == gone["long"], one(gone)).otherwise(F.lit(0).cast("long"))
            more = F.when(j == new["long"], one(new)).otherwise(F.lit(0).cast("long"))
            return c - less + more

        total = a["sum"] - F.get(step, count(a["counts"], gone)) + F.get(step, count(a["counts"], new) + 1)
        return F.when(same, a).otherwise(
            state(total, F.transform(a["counts"], other), F.least(a["least"], total))
        )

    none = state(F.lit(0.0), F.array_repeat(F.lit(0).cast("long"), LONGS), F.lit(0.0))
    first = F.aggregate(F.slice(places, 1, window), none, enter, lambda a: state(a["sum"], a["counts"], a["sum"]))
    steps = F.filter(F.sequence(F.lit(window), F.greatest(F.size(places), F.lit(window))), lambda i: i < F.size(places))
    return F.aggregate(steps, first, slide, lambda a: a["least"])


def _places(part: Column) -> Column:
    code = F.transform(F.split(part, ""), lambda ch: F.ascii(ch) - FIRST_CODE)
    return F.transform(
        code, lambda c: F.struct(F.floor(c / PER_LONG).cast("int").alias("long"), (c % PER_LONG * COUNT_BITS).alias("at"))
    )


def window_entropy(string: Column, window: int = WINDOW) -> Column:
    """Highest Shannon entropy of any window of a candidate string, in bits per character."""
    parts = F.regexp_extract_all(string, F.lit(f"(?s).{{1,{STRING_PART}}}"), F.lit(0))

    def joined(p: Column) -> Column:
        # A part begins with the last characters of the one before it; only the last may be short.
        ends = F.transform(p, lambda x: F.right(x, F.lit(window - 1)))
        before = F.slice(F.concat(F.array(F.lit("")), ends), F.lit(1), F.size(p))
        return F.zip_with(before, p, lambda b, x: F.concat(b, x))

    least = F.array_min(F.transform(bound(parts, joined), lambda x: bound(_places(x), lambda at: _least_sum(at, window))))
    return F.lit(math.log2(window)) - least / window


def _suspect(m: Column) -> Column:
    """Kind number of a candidate whose entropy is over the limit of its class, else null."""
    # Letters and digits both: cheap, and no key of the classes is without.
    mixed = m.rlike("[0-9]") & m.rlike("[A-Za-z]")
    for pattern in ALLOWED:
        mixed = mixed & ~m.rlike(pattern)
    is_hex = m.rlike("^([0-9a-f]+|[0-9A-F]+)$")
    bits = F.when(is_hex, F.lit(HEX_BITS)).otherwise(F.lit(MIXED_BITS))
    kind = F.when(is_hex, F.lit(3)).otherwise(F.lit(4))
    return F.when(mixed, F.when(window_entropy(m) >= bits, kind))


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            F.sort_array(spans),
            lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["stop"].cast("string")),
        ),
        ",",
    )


def scan_secrets(docs: DataFrame) -> DataFrame:
    """The rows of `docs` with two more columns: base_spans and spans, arrays of (start, kind, stop).

    Offsets count code points of the whole text, ends exclusive; null text is empty and has none.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = text.rlike("[:=]") & F.lower(text).rlike("password|passwd|secret|token|api_?key")
    empty = F.array().cast("array<struct<gap:int,m:string>>")
    found = with_computed(
        docs,
        _assign=F.when(keyed, _hits(text, ASSIGN)).otherwise(empty),
        _access=F.when(text.contains("AKIA"), _hits(text, ACCESS)).otherwise(empty),
        _hex=_hits(text, HEX),
        _long=_hits(text, CANDIDATE),
    )
    placed = with_computed(
        found,
        _a=F.filter(
            _placed(F.col("_assign")),
            lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 2)) >= ASSIGN_LEAST,
        ),
        _k=_placed(F.col("_access")),
        _h=_placed(F.col("_hex")),
        _c=_placed(F.col("_long")),
    ).drop("_assign", "_access", "_hex", "_long")
    based = with_computed(
        placed,
        base_spans=F.concat(_spans(F.col("_a"), 0), _spans(F.col("_k"), 1), _spans(F.col("_h"), 2)),
    )
    # Of what begins no later, the furthest end of a pattern's span says whether a candidate lies in one.
    merged = with_computed(
        based,
        _m=F.sort_array(
            F.concat(
                F.transform("base_spans", lambda b: F.struct(b["start"].alias("start"), b["stop"].alias("reach"), F.lit("").alias("m"))),
                F.transform("_c", lambda x: F.struct(x["start"].alias("start"), F.lit(END_OF_ORDER).alias("reach"), x["m"].alias("m"))),
            )
        ),
    )
    covered = with_computed(
        merged,
        _e=running(F.transform("_m", lambda x: F.when(x["reach"] < END_OF_ORDER, x["reach"]).otherwise(0)), F.greatest),
    )
    free = F.filter(
        F.zip_with("_m", "_e", lambda x, reach: F.struct(x["start"].alias("start"), x["m"].alias("m"), reach.alias("reach"))),
        lambda x: (x["m"] != "") & (x["reach"] < x["start"] + F.length(x["m"])),
    )
    judged = with_computed(
        covered,
        _s=F.transform(
            free,
            lambda x: F.struct(x["start"].alias("start"), _suspect(x["m"]).alias("kind"), (x["start"] + F.length(x["m"])).alias("stop")),
        ),
    )
    more = F.filter("_s", lambda x: x["kind"].isNotNull())
    return judged.withColumn("spans", F.concat("base_spans", more)).drop("_a", "_k", "_h", "_c", "_m", "_e", "_s")


def secret_digest(docs: DataFrame) -> DataFrame:
    """Counts and span lists per row of `docs` (doc_id, text). Empty table: empty result."""
    found = scan_secrets(docs.select("doc_id", "text"))

    def n(kind: int) -> Column:
        return F.size(F.filter("base_spans", lambda x: x["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(_listed(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


def redact_secrets(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """The rows and columns of `docs`, every span of `text` replaced by `mark`; overlaps are one span.

    Texts without a span, null and empty ones included, stay as they are; repeated rows stay; an
    empty table gives an empty table.
    """
    found = scan_secrets(boxed(docs))
    text = F.col("text")
    ordered = with_computed(found, _o=F.sort_array("spans"))
    reached = with_computed(ordered, _r=running(F.transform("_o", lambda x: x["stop"]), F.greatest))
    piece = F.zip_with(
        "_o",
        F.concat(F.array(F.lit(0)), F.slice("_r", F.lit(1), F.greatest(F.size("_r") - 1, F.lit(0)))),
        lambda x, before: F.struct(before.alias("before"), x["start"].alias("start")),
    )
    # A text is cut where a part of its pieces begins, so that pieces are looked up in short strings.
    parts = with_computed(reached, _p=bound(piece, _cut)).withColumn("_t", F.try_element_at(F.col("_r"), F.lit(-1)))

    def part_text(p: Column, j: Column) -> Column:
        base = p[0]["before"]
        end = F.coalesce(F.get("_p", j + 1)[0]["before"], F.col("_t"))
        return F.array_join(
            F.transform(
                F.array(F.struct(p.alias("pieces"), F.substring(text, base + 1, end - base).alias("region"))),
                lambda r: F.array_join(F.transform(r["pieces"], lambda x: _replaced(r["region"], x, base, mark)), ""),
            ),
            "",
        )

    rebuilt = F.concat(F.array_join(F.transform("_p", part_text), ""), F.substring(text, F.col("_t") + 1, F.length(text)))
    clean = F.when(F.size("spans") > 0, rebuilt).otherwise(text)
    return unboxed(parts, docs, clean)


def _replaced(region: Column, piece: Column, base: Column, mark: str) -> Column:
    """What stands before a span, and its mark unless it begins inside an earlier one."""
    kept = F.substring(region, piece["before"] - base + 1, F.greatest(piece["start"] - piece["before"], F.lit(0)))
    return F.concat(kept, F.when(piece["start"] >= piece["before"], F.lit(mark)).otherwise(""))
