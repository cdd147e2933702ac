"""Secret scan: fixed rules, and formats inferred from what the rules find.

The rules' matches are labelled credentials. For each rule a probabilistic automaton is learned from counts over
all of their values, and ordinary tokens' statistics from all other tokens; every other token of a text, and every part of it between separators, is scored
by how much better an automaton explains it than ordinary tokens' statistics do. The parts that beat the
automaton's limit are reported as kind ``format``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rillwork.llm.automata import (CLASS_OF, LEAST_VISITS, UNSEEN, Automaton, Background, classes, count_places,
                                   counted_tree)
from rillwork.llm.common import SLICE, arrow_map, free_name, quoted, written

#: Fixed rules: kind, pattern, the group whose length counts, least length.
RULES = (
    ("assign", re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                          r"([A-Za-z0-9+/_.=-]+)"), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)
KINDS = [kind for kind, *_ in RULES]
FORMAT = "format"
#: Characters of hex runs, of tokens and between parts of tokens, by code.
TOKEN, SEPARATORS = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_.=-", "=/."
IS_HEX, IS_TOKEN, IS_SEPARATOR = (np.isin(np.arange(256), list(chars.encode())) for chars in (
    "0123456789abcdef", TOKEN, SEPARATORS))
#: Shortest token: no rule has shorter values. Parts count from the length of a kind's shortest value on,
#: or from ``SHORTEST`` on if that is longer.
LEAST, SHORTEST = min(least for *_, least in RULES), 16
#: One in ``HELD`` values and ordinary tokens calibrates, the others train. With fewer ordinary tokens than
#: ``ENOUGH`` all characters count as equally likely in them.
HELD, ENOUGH = 4, 10
#: An automaton starts from the prefixes that at least one in ``COMMON`` of a kind's values share, up to
#: ``MEMORY`` characters, and from places in a value after those.
COMMON, MEMORY = 64, 16
#: Ratios are counted in steps of 1/``FINE`` nats, between -``FAR`` and ``FAR``.
FINE, FAR = 64, 1000
#: A limit is a log likelihood ratio within these two: ordinary tokens' statistics give a ratio of r to
#: fewer than one token in r. The lower one is for short formats, whose own values score little.
LIMITS = (math.log(1e3), math.log(1e6))
#: Rounds of learning ordinary tokens' statistics anew without those that an automaton claims.
ROUNDS = 3
#: Characters of tokens, or of their parts, that a task keeps.
KEPT = 2_000_000
#: Characters of tokens that a task works on at once.
BLOCK = 1 << 20
#: The classes of tokens' characters, no class first, and their numbers by code.
NAMES = ["", *sorted(set(classes(TOKEN)))]
NUMBER = np.zeros(256, np.int64)
NUMBER[list(TOKEN.encode())] = [NAMES.index(c) for c in classes(TOKEN)]

SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


def runs(codes: np.ndarray, kind: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(start, end) of the longest runs of characters of a kind, at least so long."""
    turns = np.flatnonzero(np.diff(kind[codes], prepend=False, append=False))
    starts, ends = turns[::2], turns[1::2]
    long = ends - starts >= least
    return list(zip(starts[long].tolist(), ends[long].tolist()))


def codes_of(text: str) -> np.ndarray:
    """One byte per code point; those outside ASCII become question marks, which no run holds."""
    return np.frombuffer(text.encode("ascii", "replace"), np.uint8)


def rule_spans(text: str, codes: np.ndarray) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value), leftmost and non-overlapping per kind."""
    found = []
    for kind, pattern, group, least in RULES:
        if kind == "hex":  # its matches are just the runs
            found += [(kind, s, e, text[s:e]) for s, e in runs(codes, IS_HEX, least)]
        elif "=" in text or ":" in text if kind == "assign" else "AKIA" in text:
            found += [(kind, m.start(), m.end(), m[group]) for m in pattern.finditer(text)
                      if len(m[group]) >= least]
    return found


def free_tokens(codes: np.ndarray, spans: list[tuple], least: int) -> list[tuple[int, int]]:
    """(start, end) of tokens, and of what spans leave of them, at least so long."""
    free = IS_TOKEN[codes]
    for _, s, e, _ in spans:
        free[s:e] = False
    return runs(free.view(np.uint8), np.array([False, True]), least)


def found_in(text: str):
    """(codes, rule spans)"""
    codes = codes_of(text)
    return codes, rule_spans(text, codes)


def borders(codes: np.ndarray) -> np.ndarray:
    """Whether a part may start at a character; at the character after a part it may also end."""
    before = np.r_[np.uint8(32), codes[:-1]]
    return ~IS_TOKEN[before] | IS_SEPARATOR[before]


@dataclass
class Formats:
    automata: list[Automaton]
    least: list[int]
    background: Background
    limits: list[float]

    def ratios(self, token: str) -> list[float]:
        """Nats by which each automaton beats ordinary tokens."""
        plain = self.background.log_chance(token)
        return [a.log_chance(token) - plain for a in self.automata]

    def best_steps(self) -> dict[str, float]:
        """The best log chance of a step by class, over all states."""
        best: dict[str, float] = {}
        for a in self.automata:
            for steps in a.steps:
                for c, (chance, _) in steps.items():
                    best[c] = max(chance, best.get(c, chance))
        return best

    def gains(self) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the nats that a character adds to a part: by the codes of the character before and of
        itself, and by its own code where it starts a part."""
        best, unseen = self.best_steps(), math.log(UNSEEN)
        step = {c: best.get(k, unseen) for c, k in zip(TOKEN, classes(TOKEN))}
        inner, first = np.zeros((256, 256)), np.zeros(256)
        for c in TOKEN:
            first[ord(c)] = max(0.0, step[c] - self.background.step("", c))
            for k, before in zip(classes(TOKEN), TOKEN):
                inner[ord(before), ord(c)] = max(0.0, step[c] - self.background.step(k, c))
        return inner, first

    def hopeful(self, codes: np.ndarray, tokens: list[tuple[int, int]], gains) -> list[tuple[int, int]]:
        """The tokens without those whose parts are certainly all below every limit."""
        if not tokens:
            return tokens
        s, e = np.array(tokens).T
        keep = self.hope(codes, s, e, gains, self.limits)
        return list(zip(s[keep].tolist(), e[keep].tolist()))

    def hope(self, codes: np.ndarray, s: np.ndarray, e: np.ndarray, gains, limits: list[float]) -> np.ndarray:
        """Which tokens, by their starts and ends, may have a part above a limit."""
        inner, first = gains
        gain = inner[np.r_[np.uint8(32), codes[:-1]], codes]
        gain = np.r_[0.0, np.cumsum(np.where(borders(codes), np.maximum(gain, first[codes]), gain))]
        return (gain[e] - gain[s] > min(limits) - 1e-6) & (e - s >= min(self.least))

    def ratios_of(self, codes: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """:meth:`ratios` of many tokens by their starts and ends: a row per automaton."""
        inside = np.repeat(np.arange(len(s)), e - s)
        at = np.arange(len(inside)) + np.repeat(s - np.r_[0, np.cumsum(e - s)[:-1]], e - s)
        chance = np.array([[self.background.step(k, chr(c)) for c in range(256)] for k in NAMES])
        kinds = np.where(at == np.repeat(s, e - s), 0, NUMBER[codes[at - 1]])
        plain = np.bincount(inside, chance[kinds, codes[at]], len(s))
        order = np.argsort(s - e, kind="stable")
        length = (e - s)[order]
        out = []
        for a in self.automata:
            steps = [[a.step(state, k) for k in NAMES] for state in range(len(a.steps))]
            cost, to = np.array([[x[0] for x in r] for r in steps]), np.array([[x[1] for x in r] for r in steps])
            state, total = np.zeros(len(s), np.int64), np.zeros(len(s))
            for i in range(length[0] if len(s) else 0):
                n = int(np.searchsorted(-length, -i))  # tokens of more than i characters
                kind = NUMBER[codes[s[order[:n]] + i]]
                total[:n] += cost[state[:n], kind]
                state[:n] = to[state[:n], kind]
            total += np.array(a.ends)[state]
            back = np.empty(len(s))
            back[order] = total
            out.append(back - plain)
        return np.array(out)

    def parts(self, token: str, limits: list[float], left: bool = True, right: bool = True
              ) -> list[tuple[int, int, float]]:
        """(start, end, nats per character) of the disjoint parts that beat their automata's limits by most in
        all. A part starts after a separator or at the token's start and ends before one or at its end; ``left``
        and ``right`` tell whether the token's own ends count."""
        kinds, n, step = classes(token), len(token), self.background.step
        starts = [left, *(c in SEPARATORS for c in token[:-1])]
        ends = [*(c in SEPARATORS for c in token[1:]), right]
        first = [step("", c) for c in token]
        inner = [first[0], *(step(k, c) for k, c in zip(kinds, token[1:]))]
        best, unseen = self.best, math.log(UNSEEN)
        rest = [0.0] * (n + 1)  # more than this cannot come
        for i in range(n - 1, -1, -1):
            plain = min(inner[i], first[i]) if starts[i] else inner[i]
            rest[i] = rest[i + 1] + max(0.0, best.get(kinds[i], unseen) - plain)
        total, found = 0.0, None
        live: dict[tuple[int, int, int], tuple] = {}
        for i, kind in enumerate(kinds):
            moved: dict[tuple[int, int, int], tuple] = {}
            options = [(key, value, inner[i]) for key, value in live.items()]
            if starts[i]:
                options += [((k, 0, 0), (total - limit, i, total, found), first[i])
                            for k, limit in enumerate(limits)]
            for (k, state, length), (score, *since), plain in options:
                chance, to = self.automata[k].step(state, kind)
                score += chance - plain
                if score + rest[i + 1] <= total:
                    continue
                key = (k, to, min(length + 1, self.least[k]))
                if key not in moved or score > moved[key][0]:
                    moved[key] = (score, *since)
            live = moved
            if ends[i]:
                over, done = total, found
                for (k, state, length), (score, start, base, before) in live.items():
                    if length == self.least[k] and (now := score + self.automata[k].ends[state]) > over:
                        over, done = now, ((start, i + 1, (now - base + limits[k]) / (i + 1 - start)), before)
                total, found = over, done
        out = []
        while found:
            out.append(found[0])
            found = found[1]
        return out[::-1]

    def __post_init__(self):
        self.best = self.best_steps()


# Training ----------------------------------------------------------------------------------------

def samples(batches):
    """(kind, value) of all labelled credentials and of all ordinary tokens (kind ''); most repeats are left
    out, as far as a task can keep what it saw."""
    seen: dict[tuple[str, str], None] = {}
    size = 0

    def rows():
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in seen], pa.string()) for k in (0, 1)],
                                          ["kind", "value"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            codes, spans = found_in(text)
            values = [(kind, value) for kind, _, _, value in spans]
            for key in values + [("", text[s:e]) for s, e in free_tokens(codes, spans, LEAST)]:
                if key not in seen:
                    seen[key] = None
                    size += len(key[1])
            if size > KEPT:
                yield rows()
                seen.clear()
                size = 0
    yield rows()


def blocks(batches):
    """(codes, starts, ends) of many values: their characters with a space after each."""
    values, size = [], 0
    for batch in batches:
        for value in batch.column(0).to_pylist():
            values.append(value)
            size += len(value) + 1
            if size > BLOCK:
                yield placed(values)
                values, size = [], 0
    if values:
        yield placed(values)


def placed(values: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.array([len(v) for v in values])
    ends = np.cumsum(lengths + 1) - 1
    return codes_of(" ".join([*values, ""])), ends - lengths, ends


def table(rows: dict, names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    """A batch of counts: the parts of the keys, then the count."""
    cols = list(zip(*((*key, n) for key, n in rows.items()))) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)


def learned(values: DataFrame, totals: dict[str, int]) -> dict[str, Automaton]:
    """An automaton per kind, from counts over all of the values (kind, value). The driver gets the sums per
    state, whose number is bounded by ``COMMON``, ``MEMORY`` and the places that count."""
    shape = F.translate("value", "".join(CLASS_OF), "".join(CLASS_OF.values()))
    prefix = F.transform(F.sequence(F.lit(1), F.least(F.length("shape"), F.lit(MEMORY))),
                         lambda i: F.substring("shape", F.lit(1), i))
    enough = F.lit(LEAST_VISITS)
    for kind, n in totals.items():
        enough = F.when(F.col("kind") == kind, max(LEAST_VISITS, -(-n // COMMON))).otherwise(enough)
    common: dict[str, set[str]] = {kind: {""} for kind in totals}
    for r in (values.select("kind", shape.alias("shape")).select("kind", F.explode(prefix).alias("prefix"))
              .groupBy("kind", "prefix").count().where(F.col("count") >= enough).collect()):
        common[r["kind"]].add(r["prefix"])

    def counted(batches):
        for batch in batches:
            rows: Counter = Counter()
            of: dict[str, list[str]] = {}
            for kind, value in zip(*(c.to_pylist() for c in batch.columns)):
                of.setdefault(kind, []).append("".join(classes(value)))
            for kind, shapes in of.items():
                rows.update({(kind, *key): n for key, n in count_places(shapes, common[kind]).items()})
            yield table(rows, ["kind", "state", "step", "left", "n"],
                        [pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64()])

    counts: dict[str, list[tuple]] = {kind: [] for kind in totals}
    for r in (values.mapInArrow(counted, "kind string, state string, step string, left int, n long")
              .groupBy("kind", "state", "step", "left").agg(F.sum("n").alias("n")).collect()):
        counts[r["kind"]].append((r["state"], r["step"], r["left"], r["n"]))
    return {kind: Automaton.merged(counted_tree(counts[kind], common[kind])) for kind in totals}


def train(texts: DataFrame) -> Formats | None:
    """Automata from a column of texts; None without a labelled credential. All distinct values and ordinary tokens
    count, in tables and sums that Spark makes; the driver gets sums per state, per pair of characters and
    quantiles. A kind with none to train on, or none to calibrate, uses all of its few values for both."""
    found = texts.where("text is not null").mapInArrow(samples, "kind string, value string").distinct()
    held = F.crc32(F.col("value").cast("binary")) % HELD == 0
    values = written(found.withColumn("held", held), "credentials")
    sizes = values.groupBy("kind", "held").agg(F.count(F.lit(1)).alias("n"), F.min(F.length("value")).alias("least"))
    sizes = {(r["kind"], r["held"]): (r["n"], r["least"]) for r in sizes.collect()}
    kinds = sorted({kind for kind, _ in sizes if kind})
    if not kinds:
        return None
    both = [k for k in kinds if len({h for kind, h in sizes if kind == k}) < 2]
    twice = F.col("kind").isin(both)
    labelled = values.where(F.col("kind") != "")
    own = labelled.where(F.col("held") | twice).select("kind", "value")
    totals = {k: sum(sizes.get((k, h), (0, 0))[0] for h in ((False, True) if k in both else (False,))) for k in kinds}
    models = learned(labelled.where(~F.col("held") | twice).select("kind", "value"), totals)
    shortest = [min([SHORTEST, *(least for (kind, _), (_, least) in sizes.items() if kind == k)]) for k in kinds]
    ordinary = values.where(F.col("kind") == "")
    plain = ordinary.where(~F.col("held")).select("value")
    n_plain = sizes.get(("", False), (0, 0))[0]
    formats = Formats([models[k] for k in kinds], shortest, Background.even(TOKEN), [LIMITS[1]] * len(kinds))
    if n_plain >= ENOUGH:
        formats.background = ordinary_only(formats, kinds, plain, n_plain, own)
    calibrating = own.unionAll(ordinary.where("held").select("kind", "value"))
    at = quantiles(calibrating, formats, kinds)
    none = [None] * 4
    for k, kind in enumerate(kinds):
        _, _, middle, upper = at.get(("", k), none)
        formats.limits[k] = limit_of(middle, upper, at.get((kind, k), none)[0])
    return formats


def quantiles(values: DataFrame, formats: Formats, kinds: list[str]) -> dict[tuple[str, int], list[float]]:
    """By kind and automaton the 0.05, 0.25, 0.5 and 0.75 quantiles of the ratios of all values (kind, value), to
    1/``FINE`` nats. Ordinary tokens meet all automata, a kind's values its own."""
    def binned(batches):
        for batch in batches:
            rows: Counter = Counter()
            of: dict[str, list[str]] = {}
            for kind, value in zip(*(c.to_pylist() for c in batch.columns)):
                of.setdefault(kind, []).append(value)
            for kind, mine in of.items():
                ratios = np.floor(np.clip(formats.ratios_of(*placed(mine)), -FAR, FAR) * FINE).astype(int)
                for k in range(len(kinds)) if kind == "" else [kinds.index(kind)]:
                    for bin_, n in zip(*np.unique(ratios[k], return_counts=True)):
                        rows[kind, k, int(bin_)] += int(n)
            yield table(rows, ["kind", "k", "bin", "n"], [pa.string(), pa.int32(), pa.int32(), pa.int64()])

    bins = (values.mapInArrow(binned, "kind string, k int, bin int, n long")
            .groupBy("kind", "k", "bin").agg(F.sum("n").alias("n")))
    rows = bins.groupBy("kind", "k").agg(F.expr("percentile(bin, array(0.05, 0.25, 0.5, 0.75), n)").alias("at"))
    return {(r["kind"], r["k"]): [x / FINE for x in r["at"]] for r in rows.collect()}


def ordinary_only(formats: Formats, kinds: list[str], plain: DataFrame, n_plain: int, own: DataFrame) -> Background:
    """Statistics of what no automaton claims of the tokens: hidden credentials are not ordinary. At first
    those parts count that differ from characters at random by as much as three quarters of the kind's
    own values, unless more than half of the tokens have such parts, as for a kind of plain words."""
    n = len(kinds)
    at = quantiles(own, formats, kinds)
    alone = [[math.inf] * n for _ in kinds]
    for k, kind in enumerate(kinds):
        if (kind, k) in at:
            alone[k][k] = at[kind, k][1]
    claims = claimed(plain, formats, alone)
    limits = [alone[k][k] - 1e-6 if 2 * claims.get(k, 0) <= n_plain else math.inf for k in range(n)]
    background = unclaimed(plain, formats, limits)
    for _ in range(ROUNDS):
        model = Formats(formats.automata, formats.least, background, limits)
        background = unclaimed(plain, model, [0.0] * n)
    return background


def claimed(plain: DataFrame, formats: Formats, alone: list[list[float]]) -> dict[int, int]:
    """How many tokens have parts above limits, by place in a list of limits."""
    def counted(batches):
        rows: Counter = Counter()
        gains = formats.gains()
        for codes, s, e in blocks(batches):
            for k, limits in enumerate(alone):
                for i in np.flatnonzero(formats.hope(codes, s, e, gains, limits)):
                    rows[k,] += bool(formats.parts(codes[s[i]:e[i]].tobytes().decode(), limits))
        yield table(rows, ["k", "n"], [pa.int32(), pa.int64()])

    rows = plain.mapInArrow(counted, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    return {r["k"]: r["n"] for r in rows}


def unclaimed(plain: DataFrame, formats: Formats, limits: list[float]) -> Background:
    """Statistics of what no part above these limits holds of the tokens; of the tokens, if nothing is left."""
    def counted(batches):
        rows: Counter = Counter()
        gains = formats.gains()
        for codes, s, e in blocks(batches):
            pieces, codes = [], codes.copy()
            for i in np.flatnonzero(formats.hope(codes, s, e, gains, limits)):
                token, start = codes[s[i]:e[i]].tobytes().decode(), 0
                for first, last, _ in [*formats.parts(token, limits), (len(token), len(token), 0.0)]:
                    if first > start:
                        pieces.append(token[start:first])
                    start = last
                codes[s[i]:e[i]] = 32
            for left in (codes, codes_of(" ".join(pieces))):
                inside = left != 32
                kinds = NUMBER[np.r_[np.uint8(32), left[:-1]]][inside] if len(left) else NUMBER[:0]
                pairs = np.bincount(kinds * 256 + left[inside])
                for i in np.flatnonzero(pairs).tolist():
                    rows[NAMES[i // 256], chr(i % 256)] += int(pairs[i])
        yield table(rows, ["before", "char", "n"], [pa.string(), pa.string(), pa.int64()])

    rows = (plain.mapInArrow(counted, "before string, char string, n long")
            .groupBy("before", "char").agg(F.sum("n").alias("n")).orderBy("before", "char").collect())
    if not rows:
        return unclaimed(plain, formats, [math.inf] * len(limits))
    return Background.counted({(r["before"], r["char"]): r["n"] for r in rows})


def limit(ordinary: list[float], own: list[float]) -> float:
    """The low end of the kind's own values, but not where ordinary tokens reach (far above their median, by
    their upper quartile), and within ``LIMITS``. Hidden credentials among the ordinary tokens, or words
    among the kind's values, cannot move it out of there."""
    middle, upper = np.quantile(ordinary, [0.5, 0.75]) if ordinary else (None, None)
    return limit_of(middle, upper, np.quantile(own, 0.05) if own else None)


def limit_of(middle: float | None, upper: float | None, own: float | None) -> float:
    """:func:`limit` from the ordinary tokens' median and upper quartile and the low end of the own values."""
    low, high = LIMITS
    if own is not None:
        low = max(low, float(own))
    if middle is not None:
        low = max(low, float(middle + 5 * (upper - middle)))
    return min(low, high)


# Use -----------------------------------------------------------------------------------------------

def scanner(df: DataFrame, formats: Formats | None) -> Column:
    shared = df.sparkSession.sparkContext.broadcast(formats)
    shape = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                       ("score", pa.float64())])
    known: dict[tuple, list] = {}
    gains: list = []
    held = [0]

    def parts(*token):
        if token not in known:
            text, left, right = token
            held[0] += len(text)
            if held[0] > KEPT:
                known.clear()
                held[0] = len(text)
            known[token] = shared.value.parts(text, shared.value.limits, left, right)
        return known[token]

    def inferred(text, codes, spans):
        model = shared.value
        if not gains:
            gains.append(model.gains())
        tokens = model.hopeful(codes, free_tokens(codes, spans, min(model.least)), gains[0])
        for s, e in tokens:
            left = s == 0 or not IS_TOKEN[codes[s - 1]] or bool(IS_SEPARATOR[codes[s - 1]])
            right = e == len(codes) or not IS_TOKEN[codes[e]] or bool(IS_SEPARATOR[codes[e]])
            for start, end, x in parts(text[s:e], left, right):
                yield s + start, s + end, x

    def run(texts):
        rows = []
        for text in texts:
            codes, spans = found_in(text or "")
            row = [(s, KINDS.index(k), {"kind": k, "start": s, "end": e, "score": None})
                   for k, s, e, _ in spans]
            if text and shared.value is not None:
                row += [(s, len(KINDS), {"kind": FORMAT, "start": s, "end": e, "score": x})
                        for s, e, x in inferred(text, codes, spans)]
            rows.append([r[2] for r in sorted(row, key=lambda r: r[:2])])
        return pa.array(rows, pa.list_(shape))

    return arrow_map(run, SPANS)


def scan(df: DataFrame, text_col: str = "text", to: str = "spans") -> DataFrame:
    """The frame with an array of spans (kind, start, end in code points, end exclusive; score of
    inferred ones), by start, then kind. A column of that name is replaced.

    Null and empty texts have no spans. Formats are learned from this frame; without any credential in it
    only the rules apply. Inferred spans never touch a rule's span.
    """
    formats = train(df.select(quoted(text_col).alias("text")))
    return df.withColumn(to, scanner(df, formats)(quoted(text_col)))


def redact(df: DataFrame, text_col: str = "text", mask: str = "[secret]") -> DataFrame:
    """The frame with every span of the text replaced by the mask; columns as before."""
    def run(texts, spans):
        out = []
        for text, found in zip(texts, spans):
            kept, at = [], 0
            for s in found or []:
                if s["end"] > at:
                    kept += [text[at:s["start"]], mask] if s["start"] >= at else []
                    at = s["end"]
            out.append(text if text is None else "".join([*kept, text[at:]]))
        return pa.array(out, pa.string())

    spans = free_name(df, "spans")
    found = scan(df, text_col, spans)
    masked = arrow_map(run, "string")(quoted(text_col), F.col(spans))
    return found.withColumn(text_col, masked).select(*map(quoted, df.columns))


def span_text(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])),
                        ",")
