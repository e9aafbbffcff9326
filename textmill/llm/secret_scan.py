"""Secret scans: fixed patterns, and candidate strings of high entropy.

The base kinds are patterns (assignments, access keys, hex runs).  Beyond them
every run of 20 or more characters of the base64 alphabet is a candidate.  A
window slides over it, and its Shannon entropy follows from the counts of its
characters: with S the sum of c log2 c over them, H = log2 W - S / W, and a
step changes two counts, so S gets two differences.  Windows are measured by
the character class of their candidate (hex digits, or the wider alphabet),
each with a threshold of its own; candidates that an allow-list names, that
lack digits or letters, or that lie inside a base span add nothing.

Everything is one narrow projection of DataFrame expressions: no shuffle and
no Python.  Positions of matches are running sums over the pieces between
them, taken in blocks, so a text with many matches costs little more than
linear time; long candidates are cut into overlapping pieces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.barrier import materialize

# The base patterns, their least lengths and the order of kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")

WINDOW = 20
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"  # at least a window
THRESHOLDS = {"entropy_hex": 3.0, "entropy_base64": 3.8}   # bits a character
LOWEST, SYMBOLS = 43, 80   # code points 43 ("+") to 122 ("z")
ALLOWED = (r"^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$", "example", "sample", "placeholder", "x{4}", "0123456789", "abcdefgh", "qwertyui")
PIECE = 512    # windows of a candidate measured together
BLOCK = 256    # matches whose positions are summed together


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def _with_matches(df: DataFrame, name: str, pattern: str) -> DataFrame:
    """Adds ``name``: array of (start, end, found) of the pattern's matches in
    the column ``body``, leftmost and not overlapping, in code points."""
    df = materialize(df, "_m", F.struct(F.split("body", pattern, -1).alias("between"),
                                        F.regexp_extract_all("body", F.lit(pattern), F.lit(0)).alias("found")))
    df = df.withColumn("_m", F.when(F.size("_m.found") > 0, F.col("_m")))
    df = materialize(df, "_s", F.transform("_m.found", lambda x, i: (F.char_length(F.get("_m.between", i)) + F.char_length(x)).cast("long")))
    of_block = F.transform(F.sequence(F.lit(0), F.floor((F.size("_s") - 1) / BLOCK).cast("int")),
                           lambda b: _sum(F.slice("_s", b * BLOCK + 1, F.lit(BLOCK))))
    df = materialize(df, "_b", of_block)
    df = materialize(df, "_b", F.transform("_b", lambda x, b: _sum(F.slice("_b", F.lit(1), b))))

    def span(x: Column, i: Column) -> Column:
        block = F.floor(i / BLOCK).cast("int")
        end = F.get("_b", block) + _sum(F.slice("_s", block * BLOCK + 1, i % BLOCK + 1))
        return F.struct((end - F.char_length(x)).alias("start"), end.alias("end"), x.alias("found"))

    empty = F.array().cast("array<struct<start:bigint,end:bigint,found:string>>")
    df = materialize(df, name, F.coalesce(F.transform("_m.found", span), empty))
    return df.drop("_m", "_s", "_b")


def _term(c: Column) -> Column:
    """c log2 c."""
    return F.when(c > 1, c * F.log2(c)).otherwise(F.lit(0.0))


def hot_windows(piece: Column, least: Column) -> Column:
    """Of a string of the candidate alphabet (bytes): struct of n, the windows
    whose entropy is ``least`` or more, and the first and the last of them."""
    state = "struct<counts:array<int>,s:double,at:int,n:int,first:int,last:int>"

    def measure(codes: Column) -> Column:
        def step(a: Column, code: Column) -> Column:
            at = a["at"]
            gone = F.when(at >= WINDOW, F.get(codes, at - WINDOW)).otherwise(F.lit(-1))
            more, less = F.get(a["counts"], code), F.get(a["counts"], gone)
            moved = (_term(more + 1) - _term(more)) + F.when(gone >= 0, _term(less - 1) - _term(less)).otherwise(0.0)
            s = F.when(gone == code, a["s"]).otherwise(a["s"] + moved)
            counts = F.when(gone == code, a["counts"]).otherwise(F.transform(a["counts"], lambda c, k: (
                c + F.when(k == code, 1).when(k == gone, -1).otherwise(0)).cast("int")))
            start = at - (WINDOW - 1)
            hot = (start >= 0) & (F.log2(F.lit(float(WINDOW))) - s / WINDOW >= least)
            return F.struct(counts.alias("counts"), s.alias("s"), (at + 1).alias("at"), F.when(hot, a["n"] + 1).otherwise(a["n"]).alias("n"),
                            F.when(hot & (a["n"] == 0), start).otherwise(a["first"]).alias("first"),
                            F.when(hot, start).otherwise(a["last"]).alias("last")).cast(state)

        zero = F.struct(F.array_repeat(F.lit(0), SYMBOLS).alias("counts"), F.lit(0.0).alias("s"), *(F.lit(0).alias(x) for x in ("at", "n", "first", "last")))
        return F.aggregate(codes, zero.cast(state), step, lambda a: F.struct(
            a["n"].alias("n"), a["first"].alias("first"), a["last"].alias("last")))

    codes = F.transform(F.split(piece.cast("string"), ""), lambda c: F.ascii(c) - LOWEST)
    return F.get(F.transform(F.array(codes), measure), F.lit(0))


def _entropy_spans(candidates: Column, base: Column, allowed: str) -> Column:
    """Array of (kind, start, end): of each candidate the part from its first
    to its last window of high entropy."""
    def measured(c: Column) -> Column:
        body = c["found"].cast("binary")
        kind = F.when(c["found"].rlike("^[0-9A-Fa-f]+$"), "entropy_hex").otherwise("entropy_base64")
        least = F.when(kind == "entropy_hex", THRESHOLDS["entropy_hex"]).otherwise(THRESHOLDS["entropy_base64"])
        last = (c["end"] - c["start"] - WINDOW).cast("int")

        def piece(o: Column) -> Column:
            hot = hot_windows(F.substring(body, o + 1, F.lit(PIECE + WINDOW - 1)), least)
            return F.transform(F.array(hot), lambda h: F.when(h["n"] > 0, F.struct(
                kind.alias("kind"), (c["start"] + o + h["first"]).alias("start"), (c["start"] + o + h["last"] + WINDOW).alias("end"))))[0]

        return F.filter(F.transform(F.sequence(F.lit(0), last, F.lit(PIECE)), piece), lambda s: s.isNotNull())

    def joined(spans: Column) -> Column:
        return F.struct(spans[0]["kind"].alias("kind"), F.array_min(F.transform(spans, lambda s: s["start"])).alias("start"),
                        F.array_max(F.transform(spans, lambda s: s["end"])).alias("end"))

    mixed = lambda c: c["found"].rlike("[0-9]") & c["found"].rlike("[A-Za-z]") & ~c["found"].rlike(allowed)
    hot = F.filter(F.transform(F.filter(candidates, mixed), measured), lambda spans: F.size(spans) > 0)
    return F.filter(F.transform(hot, joined), lambda s: ~F.exists(base, lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"])))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", allowed: Sequence[str] = ALLOWED) -> DataFrame:
    """(id, base, added), a row for every row of ``docs``: arrays of (kind,
    start, end) in code points, end exclusive, by start and then kind in the
    order of KINDS.  No other column is read.

    base: whole matches of the three patterns, leftmost and not overlapping
    within a kind; an assignment whose value has fewer than six characters
    takes its place but is dropped.  added: parts of high entropy (see the
    module) that no base span covers; ``allowed`` are patterns, in either
    case, of candidates to leave out.  Null texts count as empty and have no
    spans; repeated rows give the same spans; an empty table gives no row."""
    rule = "(?i)" + "|".join(f"(?:{p})" for p in allowed) if allowed else r"(?!)"
    df = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    for name, pattern in (("m_assign", ASSIGN), ("m_access", ACCESS), ("m_hex", HEX), ("m_candidate", CANDIDATE)):
        df = _with_matches(df, name, pattern)
    long_enough = lambda m: F.char_length(F.regexp_extract(m["found"], rf"\A{ASSIGN}\z", 2)) >= ASSIGN_LEAST
    ranked = lambda k: lambda m: F.struct(m["start"].alias("start"), F.lit(k).alias("rank"), m["end"].alias("end"))
    kinds = [F.transform(x, ranked(k)) for k, x in enumerate((F.filter("m_assign", long_enough), F.col("m_access"), F.col("m_hex")))]
    names = F.array(*(F.lit(k) for k in KINDS))
    by_name = lambda s: F.struct(F.get(names, s["rank"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    df = materialize(df.drop("body"), "base", F.transform(F.array_sort(F.concat(*kinds)), by_name)).drop("m_assign", "m_access", "m_hex")
    added = _entropy_spans(F.col("m_candidate"), F.col("base"), rule)
    return materialize(df, "added", added).select(F.col("id").alias(id_col), "base", "added")


def merged(base: str | Column = "base", added: str | Column = "added") -> Column:
    """All spans, by start and then kind."""
    rank = F.create_map(*(F.lit(x) for pair in zip(KINDS, range(len(KINDS))) for x in pair))
    spans = F.transform(F.concat(base, added), lambda s: F.struct(s["start"].alias("start"), F.element_at(rank, s["kind"]).alias("rank"),
                                                                  s["end"].alias("end"), s["kind"].alias("kind")))
    return F.transform(F.array_sort(spans), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def as_text(spans: str | Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
