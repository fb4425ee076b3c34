"""Secret scans: three kinds of patterns, and strings of high entropy.

All work is in DataFrame functions, inside each document's row: no row is moved. A pattern is
run once to split the text and once to extract its matches; lengths summed up give the places.
Candidate strings of the entropy scan are slid over by a window whose character counts are
updated by the character that enters and the one that leaves: the work follows the length of a
candidate, and that of the text.

Defined cases: a null or empty text has no spans; a text of any length is scanned whole;
repeated rows give a row each; extra columns are kept by :func:`mask_secrets`; spans of equal
start are ordered by kind.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import whole_text
from corpusmill.operators.steps import once

# The patterns of the three kinds and their least lengths.
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]++)"""
)
ASSIGN_LEAST = 12
# A run shorter than this fails, and no later start inside it is longer: the least length can
# be part of these two patterns.
ACCESS = r"AKIA[A-Z0-9]{14,}+"
HEX = r"[0-9a-f]{16,}+"
KINDS = ("assign", "access", "hex", "entropy")
# Behind the end of every text.
_FAR = 2**31 - 1


# Code points of a piece, in which places of long texts are looked up.
PIECE = 1024


@dataclass(frozen=True)
class EntropyRule:
    """When a window of a candidate string counts as random.

    ``candidate`` cuts candidate strings. Each window has the threshold, in bits for each
    character, of the first class it fits: hex digits of one case with a letter; upper case, lower
    case and digits; lower case and digits; upper case and digits; upper and lower case. Others
    are words or numbers. Separators count for no class. Windows that overlap or touch make a
    run; ``allowed`` suppresses whole runs: plain words and numbers, joined by separators or not,
    dates, alphabets and repeated characters.
    """

    window: int = 20
    candidate: str = r"[A-Za-z0-9+/_=-]{20,}+"
    hex_bits: float = 2.8
    mixed_bits: float = 3.5
    lower_bits: float = 3.5
    upper_bits: float = 3.3
    letters_bits: float = 3.7
    # Possessive groups: they are matched in a loop, however long the run is.
    allowed: str = (
        r"^(?:[-_=+/]++|(?:[0-9]++|[A-Z]++|[a-z]*+(?:[A-Z][a-z]{2,})*+(?:[A-Z][a-z]?)?+)"
        r"(?=[-_=+/]|[0-9]?$))*+[0-9]?$"
        r"|^(?:abcdefghijklm(?:nopqrstuvwxyz)?+|ABCDEFGHIJKLM(?:NOPQRSTUVWXYZ)?+"
        r"|0123456789(?:abcdef|ABCDEF)?+|(.)\1{7,}+|[-_=+/])++$"
    )

    def bits(self, lower: Column, lower_rest: Column, upper: Column, upper_rest: Column, digit: Column) -> Column:
        """The threshold of a string that has characters of these kinds, or null."""
        pure = (lower & ~lower_rest & ~upper) | (upper & ~upper_rest & ~lower)
        return (
            F.when(pure, F.lit(self.hex_bits))
            .when(lower & upper & digit, F.lit(self.mixed_bits))
            .when(lower & digit, F.lit(self.lower_bits))
            .when(upper & digit, F.lit(self.upper_bits))
            .when(lower & upper, F.lit(self.letters_bits))
        )

    @property
    def lowest(self) -> float:
        return min(self.hex_bits, self.mixed_bits, self.lower_bits, self.upper_bits, self.letters_bits)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _swept(items: Column, start: dict[str, Column], step, item: str, last=None) -> Column:
    """What the steps of a fold emit, as a list of ``item``.

    ``step(state, x)`` gives the next state, a struct, and whether something is emitted, and that;
    ``last`` gives what the final state emits. A fold copies its whole state at each step, so the
    list is grown block by block, with as many blocks as a block has items.
    """
    nothing = F.array().cast(f"array<{item}>").alias("out")

    def emitted(state: Column, x: Column) -> Column:
        following, more, one = step(state, x)
        out = F.when(more, F.concat(state["out"], F.array(one))).otherwise(state["out"])
        return _bound(following, lambda now: F.struct(*[now[k].alias(k) for k in start], out.alias("out")))

    def whole(xs: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(xs))).cast("int") + 1

        def block(state: Column, k: Column) -> Column:
            joined = lambda end: F.struct(
                *[end[c].alias(c) for c in start], F.concat(state["out"], end["out"]).alias("out")
            )
            begin = F.struct(*[state[c].alias(c) for c in start], nothing)
            return F.aggregate(F.slice(xs, k * size + 1, size), begin, emitted, joined)

        begin = F.struct(*[v.alias(c) for c, v in start.items()], nothing)
        rest = (lambda end: end["out"]) if last is None else (lambda end: F.concat(end["out"], last(end)))
        return F.aggregate(F.sequence(F.lit(0), size - 1), begin, block, rest)

    return _bound(items, whole)


def _spans(text: Column, pattern: str, kind: str, ok: Column | None = None) -> Column:
    """Matches as ``array<struct<start, kind, end, found>>``; places count code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    order = KINDS.index(kind)
    gaps = F.split(text, pattern, -1)
    pairs = F.arrays_zip(
        gaps.alias("gap"), found.alias("found"), *([] if ok is None else [ok.alias("ok")])
    )
    # One gap more than matches: the last pair has no match.
    pairs = F.slice(pairs, F.lit(1), F.size(gaps) - 1)

    def place(seen: Column, pair: Column):
        start = seen["at"] + F.length(pair["gap"])
        end = start + F.length(pair["found"])
        span = F.struct(
            start.alias("start"),
            F.lit(order).alias("kind"),
            end.alias("end"),
            pair["found"].alias("found"),
        )
        return F.struct(end.alias("at")), F.lit(True) if ok is None else pair["ok"], span

    item = "struct<start:int,kind:int,end:int,found:string>"
    placed = _swept(pairs, {"at": F.lit(0)}, place, item)
    none = F.array().cast(f"array<{item}>")
    return F.when(F.rlike(text, F.lit(pattern)), placed).otherwise(none)


def _long_enough(text: Column) -> Column:
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    return F.transform(values, lambda v: F.length(v) >= ASSIGN_LEAST)


def _runs(found: Column, chars: Column, rule: EntropyRule) -> Column:
    """``array<struct<first, last>>``: starts and ends of all maximal runs of random windows.

    One step for each character. Its counts, by character and by kind, follow the character that
    enters the window and the one that leaves it.
    """
    window = rule.window
    kinds = {
        "lower": lambda c: c.between("a", "z"),
        "lower_rest": lambda c: c.between("g", "z"),
        "upper": lambda c: c.between("A", "Z"),
        "upper_rest": lambda c: c.between("G", "Z"),
        "digit": lambda c: c.between("0", "9"),
    }
    classes = {"lower": "[a-z]", "lower_rest": "[g-z]", "upper": "[A-Z]", "upper_rest": "[G-Z]", "digit": "[0-9]"}
    whole = rule.bits(**{k: F.rlike(found, F.lit(p)) for k, p in classes.items()})

    def weight(n: Column) -> Column:
        return F.when(n > 1, n * F.log2(n.cast("double"))).otherwise(0.0)

    def changed(counts: Column, char: Column, n: Column) -> Column:
        others = F.map_filter(counts, lambda c, _: c != char)
        return F.when(n > 0, F.map_concat(others, F.create_map(char, n))).otherwise(others)

    def slide(state: Column, at: Column) -> Column:
        leaves = at >= window

        def entered(enter: Column) -> Column:
            had = F.coalesce(F.element_at(state["counts"], enter), F.lit(0))
            return _bound(
                F.struct(
                    changed(state["counts"], enter, had + 1).alias("counts"),
                    (state["total"] + weight(had + 1) - weight(had)).alias("total"),
                    F.when(leaves, F.get(chars, at - window)).alias("leave"),
                    *[(state[k] + is_kind(enter).cast("int")).alias(k) for k, is_kind in kinds.items()],
                ),
                left,
            )

        def left(now: Column) -> Column:
            leave = now["leave"]
            n = F.element_at(now["counts"], leave)
            return _bound(
                F.struct(
                    F.when(leaves, changed(now["counts"], leave, n - 1)).otherwise(now["counts"]).alias("counts"),
                    F.when(leaves, now["total"] + weight(n - 1) - weight(n)).otherwise(now["total"]).alias("total"),
                    *[
                        (now[k] - F.coalesce(is_kind(leave), F.lit(False)).cast("int")).alias(k)
                        for k, is_kind in kinds.items()
                    ],
                ),
                judged,
            )

        def judged(now: Column) -> Column:
            entropy = math.log2(window) - now["total"] / window
            # A part of a string of some class has the threshold of the string at most.
            bits = F.least(rule.bits(**{k: now[k] > 0 for k in kinds}), state["whole"])
            random = (at >= window - 1) & (entropy >= rule.lowest)
            random = F.coalesce(F.when(random, entropy >= bits), F.lit(False))
            return _bound(F.struct(now.alias("now"), random.alias("random")), follow)

        def follow(seen: Column) -> Column:
            now, random, begin = seen["now"], seen["random"], at - window + 1
            apart = random & (begin > state["last"])
            return F.struct(
                *[now[k].alias(k) for k in ("counts", "total", *kinds)],
                state["whole"].alias("whole"),
                F.when(apart, begin).otherwise(state["first"]).alias("first"),
                F.when(random, at + 1).otherwise(state["last"]).alias("last"),
                F.when(apart, state["first"]).otherwise(-1).alias("closed_first"),
                F.when(apart, state["last"]).otherwise(-1).alias("closed_last"),
            )

        return _bound(F.get(chars, at), entered)

    # A run is open until another one begins, and emitted by the step after that.
    open_run = lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last"))
    closed_run = lambda s: F.struct(s["closed_first"].alias("first"), s["closed_last"].alias("last"))
    start = {
        "counts": F.create_map().cast("map<string,int>"),
        "total": F.lit(0.0),
        **{k: F.lit(0) for k in kinds},
        "whole": whole,
        **{k: F.lit(-1) for k in ("first", "last", "closed_first", "closed_last")},
    }
    runs = _swept(
        F.sequence(F.lit(0), F.size(chars) - 1),
        start,
        lambda state, at: (slide(state, at), state["closed_last"] >= 0, closed_run(state)),
        "struct<first:int,last:int>",
        lambda end: F.filter(F.array(closed_run(end), open_run(end)), lambda r: r["last"] >= 0),
    )
    text_of = lambda r: F.array_join(F.slice(chars, r["first"] + 1, r["last"] - r["first"]), "")
    return F.filter(runs, lambda r: ~F.rlike(text_of(r), F.lit(rule.allowed)))


def _random_parts(found: Column, rule: EntropyRule) -> Column:
    # Only a string of some class has windows with a threshold; others are not looked into.
    some = F.rlike(found, F.lit("[a-z]")).cast("int") + F.rlike(found, F.lit("[A-Z]")).cast("int")
    some += F.rlike(found, F.lit("[0-9]")).cast("int")
    pure = F.rlike(found, F.lit("^(?:[^g-zA-Z]++|[^G-Za-z]++)$"))
    none = F.array().cast("array<struct<first:int,last:int>>")
    runs = _bound(F.split(found, "", -1), lambda chars: _runs(found, chars, rule))
    return F.when((some > 1) | pure, runs).otherwise(none)


def _without(runs: Column, base: Column) -> Column:
    """What base spans leave of runs that do not overlap each other, in one sweep over both."""
    events = F.sort_array(
        F.concat(
            F.transform(base, lambda s: F.struct(s["start"], s["end"], F.lit(0).alias("run"))),
            F.transform(runs, lambda s: F.struct(s["start"], s["end"], F.lit(1).alias("run"))),
        )
    )

    def sweep(state: Column, event: Column):
        # A base span or another run ends what is open of a run, or takes its beginning away.
        is_run = event["run"] == 1
        stop = F.least(state["end"], event["start"])
        part = F.struct(state["at"].alias("start"), F.lit(KINDS.index("entropy")).alias("kind"), stop.alias("end"))
        covered = F.when(is_run, state["covered"]).otherwise(F.greatest(state["covered"], event["end"]))
        at = F.when(is_run, F.greatest(event["start"], state["covered"])).otherwise(F.greatest(state["at"], event["end"]))
        end = F.when(is_run, event["end"]).otherwise(state["end"])
        return F.struct(covered.alias("covered"), at.alias("at"), end.alias("end")), state["at"] < stop, part

    item = "struct<start:int,kind:int,end:int>"
    # A last event behind everything closes what is open.
    last = F.array(F.struct(F.lit(_FAR).alias("start"), F.lit(_FAR).alias("end"), F.lit(0).alias("run")))
    swept = _swept(F.concat(events, last), {c: F.lit(0) for c in ("covered", "at", "end")}, sweep, item)
    return F.when(F.size(runs) > 0, swept).otherwise(F.array().cast(f"array<{item}>"))


def secret_spans(docs: DataFrame, rule: EntropyRule | None = None) -> DataFrame:
    """Add ``base`` and ``spans``: arrays of ``(start, kind, end)``, ordered.

    ``base`` has the pattern kinds. ``spans`` adds what
    those leave of the random parts.
    Existing columns of these names are replaced.
    """
    rule = rule or EntropyRule()
    text = whole_text()
    base = F.concat(
        _spans(text, ASSIGN, "assign", _long_enough(text)),
        _spans(text, ACCESS, "access"),
        _spans(text, HEX, "hex"),
    )
    plain = lambda spans: F.sort_array(
        F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"]))
    )
    found = once(docs.drop("base", "spans"), "base", plain(base))
    runs = F.flatten(
        F.transform(
            _spans(text, rule.candidate, "entropy"),
            lambda s: F.transform(
                _random_parts(s["found"], rule),
                lambda r: F.struct(
                    (s["start"] + r["first"]).alias("start"), (s["start"] + r["last"]).alias("end")
                ),
            ),
        )
    )
    fresh = _bound(runs, lambda own: _without(own, F.col("base")))
    return found.withColumn("spans", F.sort_array(F.concat("base", fresh)))


def _between(pieces: Column, part: Column) -> Column:
    """Code points from ``start`` to ``end`` of a text that is cut into pieces."""

    def own(piece: Column) -> Column:
        begin = F.greatest(part["start"] - piece * PIECE, F.lit(0))
        end = F.least(part["end"] - piece * PIECE, F.lit(PIECE))
        return F.substring(F.get(pieces, piece), begin + 1, end - begin)

    last = F.call_function("div", part["end"] - 1, F.lit(PIECE)).cast("int")
    first = F.call_function("div", part["start"], F.lit(PIECE)).cast("int")
    found = F.array_join(F.transform(F.sequence(first, last), own), "")
    return F.when(part["start"] < part["end"], found).otherwise("")


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
        ),
        ",",
    )


def mask_secrets(docs: DataFrame, mask: str = "[SECRET]", rule: EntropyRule | None = None) -> DataFrame:
    """Put ``mask`` in place of every secret; overlapping spans become one.

    The columns stay as they are, but for ``n_chars``, which follows the text where it is there.
    """
    names = docs.columns
    # Under numbered names no column of the documents clashes with those of the scan.
    numbered = [docs[c].alias(f"_{i}") for i, c in enumerate(names)]
    found = secret_spans(docs.select(*numbered, "text"), rule)

    open_span = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))

    def join(seen: Column, span: Column):
        # What is open goes to the list when a span starts behind it.
        apart = span["start"] > seen["end"]
        start = F.when(apart, span["start"]).otherwise(seen["start"])
        end = F.when(apart, span["end"]).otherwise(F.greatest(seen["end"], span["end"]))
        return F.struct(start.alias("start"), end.alias("end")), apart & (seen["end"] >= 0), open_span(seen)

    item = "struct<start:int,end:int>"
    found_any = {"start": F.lit(-1), "end": F.lit(-1)}
    joined = _swept(F.col("spans"), found_any, join, item, lambda end: F.array(open_span(end)))
    joined = F.when(F.size("spans") > 0, joined).otherwise(F.array().cast(f"array<{item}>"))
    merged = once(found, "_merged", joined)
    starts = F.concat(F.transform("_merged", lambda s: s["start"]), F.array(F.length("text")))
    ends = F.concat(F.array(F.lit(0)), F.transform("_merged", lambda s: s["end"]))
    left = F.arrays_zip(ends.alias("start"), starts.alias("end"))
    cut = F.regexp_extract_all("text", F.lit("(?s).{1,%d}" % PIECE), F.lit(0))
    masked = _bound(
        cut, lambda pieces: F.array_join(F.transform(left, lambda part: _between(pieces, part)), mask)
    )
    cleaned = once(
        merged, "_clean", F.when(F.size("_merged") > 0, masked).otherwise(F.col("text"))
    )
    columns = []
    for i, c in enumerate(names):
        old = F.col(f"_{i}")
        if c == "text":
            old = F.col("_clean")
        elif c == "n_chars":
            length = F.length("_clean").cast(docs.schema[c].dataType)
            old = F.when(F.size("_merged") > 0, length).otherwise(old)
        columns.append(old.alias(c))
    return cleaned.select(*columns)
