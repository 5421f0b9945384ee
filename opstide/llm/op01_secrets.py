"""Secret scans with DataFrame functions only: fixed patterns and sliding-window entropy."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents_of, unused

#: Kinds in order of listing, with their patterns. Matches below the least lengths are dropped after matching.
#: Hex runs and access ids are maximal runs of a class, so a least length inside the pattern finds the same ones.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ["assign", "access", "hex", "entropy"]
LEAST_VALUE = 12
#: Strings that are candidates for the entropy scan.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Characters in a window.
WINDOW = 20
#: Character classes of candidates, narrowest first: pattern of the whole string, symbols, bits per character to report.
CLASSES = [
    (r"^[0-9a-f]+$", "0123456789abcdef", 3.0),
    (r"^[A-Z0-9]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 3.3),
    (r"^[A-Za-z0-9+/_=-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.7),
]
#: Candidates that are not secrets: without a digit or without a letter, unique ids, words with separators.
#: Repeated groups are possessive: what follows them cannot take a part back, and they match without recursion.
ALLOWED = [
    r"^[^0-9]*$",
    r"^[^A-Za-z]*$",
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^[A-Za-z]+([_-][A-Za-z]+)++[_-]?[0-9]{0,4}$",
]
#: Candidates that are no secrets as a whole but may hold one in a part: dates, paths, samples.
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T_/-]?"
TRUSTED = [
    DATE,
    r"^/?([A-Za-z]+[0-9]{0,3}/)++[A-Za-z0-9_-]*$",
    r"(?i)example|sample|placeholder|xxxxx|test_?key",
]
#: Parts that are words and short numbers.
SLUG = r"^([A-Za-z]+|[0-9]{1,4})([_-]([A-Za-z]+|[0-9]{1,4}))++$"
#: Values of a block of running sums, and characters that a long text is cut into.
BLOCK, CUT = 128, 1024
SPAN = "array<struct<start:bigint,end:bigint,text:string>>"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _running(values: Column, op) -> Column:
    """``op`` over all values before each one, from 0. Works block by block, so cost grows with the number of values, not its square."""
    zero = F.lit(0).cast("bigint")

    def over(block: Column, base: Column) -> Column:
        return F.aggregate(block, F.array(base), lambda a, v: F.concat(a, F.array(op(F.element_at(a, -1), v))))

    def blocked(own: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), (F.size(own) / BLOCK).cast("int")), lambda n: F.slice(own, n * BLOCK + 1, F.lit(BLOCK)))

    def joined(blocks: Column) -> Column:
        bases = over(F.transform(blocks, lambda block: F.aggregate(block, zero, op)), zero)
        whole = F.zip_with(blocks, F.slice(bases, F.lit(1), F.size(blocks)), lambda block, base: F.slice(over(block, base), F.lit(1), F.size(block)))
        return F.flatten(whole)

    return _let(values, lambda own: _let(blocked(own), joined))


def _spans(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches with code point offsets: lengths of the pieces between matches and of the matches, summed up."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.zip_with(F.split(text, pattern, -1), found, lambda p, m: F.struct(F.char_length(p).cast("bigint").alias("gap"), m.alias("text")))

    def placed(own: Column) -> Column:
        sizes = F.transform(own, lambda x: x["gap"] + F.coalesce(F.char_length(x["text"]), F.lit(0)))
        spans = F.zip_with(
            own,
            _running(sizes, lambda a, n: a + n),
            lambda x, at: F.struct(
                (at + x["gap"]).alias("start"), (at + x["gap"] + F.char_length(x["text"])).alias("end"), x["text"].alias("text")
            ),
        )
        return F.slice(spans, F.lit(1), F.size(own) - 1)  # after the last match there is a piece only

    return F.when(F.size(found) > 0, _let(pieces, placed)).otherwise(F.array().cast(SPAN))


def _entropy(string: Column, symbols: str) -> Column:
    """Highest Shannon entropy, in bits per character, of any window of the string.

    The window slides by one character: the sum of c log2 c over its symbol
    counts changes only in the counts of the character that enters and the
    one that leaves.
    """
    n = len(symbols)
    code = F.transform(F.split(string, ""), lambda c: F.instr(F.lit(symbols), c) - 1)
    weight = F.array(*[F.lit(0.0 if c < 2 else c * math.log2(c)) for c in range(WINDOW + 2)])
    leaving = F.concat(F.array_repeat(F.lit(-1), WINDOW), code)
    moves = F.slice(F.zip_with(code, leaving, lambda i, o: F.struct(i.alias("i"), o.alias("o"))), 1, F.char_length(string))
    start = F.struct(
        F.array_repeat(F.lit(0), n).alias("counts"),
        F.lit(0.0).alias("sum"),
        F.lit(0).alias("seen"),
        F.lit(float(WINDOW * math.log2(WINDOW))).alias("least"),
    )

    def step(a: Column, m: Column) -> Column:
        entering = F.coalesce(F.get(a["counts"], m["i"]), F.lit(0))
        gone = F.when(m["o"] >= 0, F.get(a["counts"], m["o"]) + F.when(m["o"] == m["i"], 1).otherwise(0)).otherwise(F.lit(0))
        total = (
            a["sum"]
            + F.get(weight, entering + 1)
            - F.get(weight, entering)
            + F.when(gone > 0, F.get(weight, gone - 1) - F.get(weight, gone)).otherwise(0.0)
        )
        counts = F.transform(
            a["counts"],
            lambda c, k: c + F.when(k == m["i"], 1).otherwise(0) - F.when(k == m["o"], 1).otherwise(0),
        )
        seen = a["seen"] + 1
        return F.struct(
            counts.alias("counts"),
            total.alias("sum"),
            seen.alias("seen"),
            F.when(seen >= WINDOW, F.least(a["least"], total)).otherwise(a["least"]).alias("least"),
        )

    return F.lit(math.log2(WINDOW)) - F.aggregate(moves, start, step, lambda a: a["least"]) / WINDOW


def _any(string: Column, patterns: list[str]) -> Column:
    hit = F.lit(False)
    for pattern in patterns:
        hit = hit | string.rlike(pattern)
    return hit


def is_secret(string: Column) -> Column:
    """Whether a candidate has a window of high entropy for its class and is on no allow-list.

    A date, a path or a sample is judged by its parts: those between slashes,
    what follows the date, and those between any separators, each of them
    unless it is on a list itself or made of words and short numbers.
    """
    parts = F.concat(F.split(string, "/"), F.array(F.regexp_replace(string, DATE, "")), F.split(string, "[/_=-]"))
    long = F.filter(parts, lambda p: F.char_length(p) >= WINDOW)
    odd = F.filter(long, lambda p: ~_any(p, [*ALLOWED, *TRUSTED, SLUG]))
    judged = F.when(_any(string, ALLOWED), F.array().cast("array<string>")).when(_any(string, TRUSTED), odd).otherwise(F.array(string))

    def high(part: Column) -> Column:
        verdict = F.when(F.lit(False), False)
        for pattern, symbols, bits in CLASSES:
            verdict = verdict.when(part.rlike(pattern), _entropy(part, symbols) >= bits)
        return verdict.otherwise(False)

    return F.exists(judged, high)


def secret_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, assign, access, hex, entropy): arrays of (start, end, text) per kind, a row per row of ``docs``.

    Offsets are code points, end exclusive. Null texts count as empty.
    """
    return documents_of(docs).select("doc_id", *_kind_columns(F.col("text")))


def _kind_columns(text: Column) -> list[Column]:
    assign = F.filter(_spans(text, ASSIGN), lambda s: F.char_length(F.regexp_extract(s["text"], ASSIGN, 2)) >= LEAST_VALUE)
    entropy = F.filter(_spans(text, CANDIDATE), lambda s: is_secret(s["text"]))
    return [assign.alias("assign"), _spans(text, ACCESS).alias("access"), _spans(text, HEX).alias("hex"), entropy.alias("entropy")]


def _joined(kinds: list[str]) -> Column:
    """kind:start:end of all spans by start, then kind as listed, then end, comma-joined."""
    def labelled(rank: int, kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))

    parts = [labelled(n, kind) for n, kind in enumerate(kinds)]
    ordered = F.array_sort(F.concat(*parts))
    named = F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(named, ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans), a row per row of ``docs``.

    ``base_sha256`` is the digest of the three fixed kinds' span list, that of
    the empty string where there is none; ``spans`` lists all spans.
    """
    found = secret_spans(docs)
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined(KINDS[:3]), 256).alias("base_sha256"),
        _joined(KINDS).alias("spans"),
    )


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of every kind replaced by ``mark``; overlapping spans are one. Null texts stay null.

    ``n_chars``, where there is such a column, follows the new text. All other
    columns stay as they are.
    """
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    names = [unused(docs, f"__{k}") for k in KINDS]
    found = unused(docs, "__spans")
    rows = docs.select("*", *[c.alias(n) for c, n in zip(_kind_columns(text), names)])
    bare = [F.transform(n, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))) for n in names]
    rows = rows.withColumn(found, F.array_sort(F.concat(*bare))).drop(*names)
    cut = F.regexp_extract_all(F.col("text"), F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0))

    def part(cuts: Column, a: Column, b: Column) -> Column:
        first = F.floor(a / CUT).cast("int")
        own = F.array_join(F.slice(cuts, first + 1, F.floor((b - 1) / CUT).cast("int") - first + 1), "")
        return F.when(b > a, F.substring(own, (a % CUT + 1).cast("int"), (b - a).cast("int"))).otherwise("")

    def marked(cuts: Column) -> Column:
        reached = _running(F.transform(found, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
        pieces = F.zip_with(found, reached, lambda s, at: F.concat(part(cuts, at, s["start"]), F.when(s["start"] < at, "").otherwise(mark)))
        last = F.array_max(F.transform(found, lambda s: s["end"]))
        return F.concat(F.array_join(pieces, ""), part(cuts, last, F.char_length("text").cast("bigint")))

    whole = _let(cut, marked)
    rows = rows.withColumn("text", F.when(F.size(found) > 0, whole).otherwise(F.col("text"))).drop(found)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(docs.schema["n_chars"].dataType)))
    return rows.select(docs.columns)
