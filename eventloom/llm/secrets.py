"""Secret scans: patterns find credentials, automata learned from them find more.

What the patterns match are labelled credentials.  From all of them, and from all ordinary
tokens, grammar inference builds two probabilistic automata over character classes: a prefix
tree whose states are merged while their statistics agree.  Spark counts prefixes, moves of the
automata and scores over the table of distinct tokens; the driver gets sums only.  Every other
token as long as the shortest credential, and what base spans leave of tokens, is scored by how
much likelier its format is among credentials.  Ordinary tokens weigh by stratum, the set of
character classes that a token has, so that rare formats (addresses, numbers, dates) count.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, drop_table, keep_table, ship
from .tokens import slices

# The base patterns.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST = 6  # length of the shortest credential
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{6,}")
MARKS = "+/_.=-"
KINDS = ("assign", "access", "hex", "format")

UNIT = 1 << 20  # weights are whole multiples of 1 / UNIT: their sums do not depend on the order
FINE = 1 << 12  # of rates in sums, likewise
PREFIXES = 50_000  # of credentials: what the driver holds is bounded by this times their length
HELD = 100_000  # distinct tokens that a task holds before it hands them on

SYMBOLS = 10
_CLASS = np.full(256, 255, np.uint8)
for _i, _some in enumerate(
    ["abcdef", "ghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", *"+/_.=-"]
):
    _CLASS[list(_some.encode())] = _i


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, credential) by start, then kind; leftmost, not overlapping per kind."""
    found = [
        (m.start(), 0, m.end(), m.group(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST
    ]
    # the other kinds are made of token characters only, so they lie within long tokens
    for token in TOKEN.finditer(text):
        for kind, pattern in ((1, ACCESS), (2, HEX)):
            for m in pattern.finditer(text, token.start(), token.end()):
                found.append((m.start(), kind, m.end(), m.group()))
    return sorted(found)


def other_tokens(text: str, spans: list[tuple[int, int, int, str]]) -> list[tuple[int, str, bool]]:
    """(start, token, whole): tokens, or what base spans leave of them without marks at a cut."""
    if not spans:
        return [(m.start(), m.group(), True) for m in CANDIDATE.finditer(text)]
    taken: list[list[int]] = []
    for start, _, end, _ in spans:
        if taken and start <= taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], end)
        else:
            taken.append([start, end])
    out, at = [], 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        cuts = [(start, start)]
        for k in range(at, len(taken)):
            if taken[k][0] >= end:
                break
            cuts.append((max(taken[k][0], start), min(taken[k][1], end)))
        cuts.append((end, end))
        for i in range(len(cuts) - 1):
            (_, a), (b, _) = cuts[i], cuts[i + 1]
            piece = text[a:b]
            if i > 0:
                piece = piece.lstrip(MARKS)
                a = b - len(piece)
            if i < len(cuts) - 2:
                piece = piece.rstrip(MARKS)
            if len(piece) >= LEAST:
                out.append((a, piece, len(cuts) == 2))
    return out


# ---- grammar inference -----------------------------------------------------


def classes_of(token: str) -> np.ndarray:
    return _CLASS[np.frombuffer(token.encode(), np.uint8)]


def strata(tokens: list[str]) -> np.ndarray:
    """The set of character classes of each token, as bits; no token is empty."""
    if not tokens:
        return np.zeros(0, np.int64)
    size = np.array([len(t) for t in tokens], np.int64)
    bits = np.int64(1) << classes_of("".join(tokens)).astype(np.int64)
    return np.bitwise_or.reduceat(bits, np.cumsum(size) - size)


BASE = np.uint64(0x9E3779B97F4A7C15)
_TERMS = np.random.default_rng(11).integers(0, 2**64, SYMBOLS, np.uint64)
PREFIX = 2**60 - 1  # the part of a prefix's hash that is kept, beside what follows it


def _steps(symbols: np.ndarray, powers: np.ndarray) -> np.ndarray:
    """What symbols add to the hash of the prefix before them; ``powers`` of BASE by its length."""
    return _TERMS[symbols] * powers


def prefix_moves(tokens: list[str], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each prefix's hash (times 16) with the symbol, or end, that follows, and the weight of tokens."""
    size = np.array([len(t) for t in tokens], np.int64)
    token = np.repeat(np.arange(len(tokens)), size)
    begin = np.cumsum(size) - size
    symbols = classes_of("".join(tokens)).astype(np.int64)
    powers = np.full(int(size.max(initial=0)) + 1, BASE)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    sums = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(_steps(symbols, powers[np.arange(len(symbols)) - begin[token]]), out=sums[1:])
    before = sums[:-1] - sums[begin][token]
    whole = sums[begin + size] - sums[begin]
    keys = np.concatenate([before << np.uint64(4) | symbols.astype(np.uint64), whole << np.uint64(4) | np.uint64(SYMBOLS)])
    keys, at = np.unique(keys.view(np.int64), return_inverse=True)
    out = np.zeros(len(keys), np.int64)
    np.add.at(out, at, np.concatenate([weights[token], weights]))
    return keys, out


class Automaton:
    """A deterministic probabilistic automaton inferred from sequences of symbols."""

    def __init__(self, sequences: list[np.ndarray], alpha: float = 0.05, symbols: int = SYMBOLS):
        self._begin(symbols)
        for sequence in sequences:
            state = 0
            for symbol in sequence.tolist():
                self.seen[state] += 1
                self.uses[state][symbol] = self.uses[state].get(symbol, 0) + 1
                to = self.next[state].get(symbol)
                if to is None:
                    to = self._new(state, symbol)
                state = to
            self.seen[state] += 1
            self.ends[state] += 1
        self._infer(alpha)

    @classmethod
    def of_prefixes(cls, prefixes: dict[int, list[float]], alpha: float = 0.05) -> Automaton:
        """From prefixes by their hash: how often each symbol follows, and last the end.

        A prefix that is not listed leads to the first state, with which one that occurs once
        would be merged.
        """
        self = cls.__new__(cls)
        self._begin(SYMBOLS)
        level, power = [(0, 0)], 1
        while level:
            steps = _steps(np.arange(SYMBOLS), np.uint64(power))
            below = []
            for state, prefix in level:
                follow = prefixes.get(prefix & PREFIX, [0.0] * (SYMBOLS + 1))
                self.seen[state], self.ends[state] = sum(follow), follow[SYMBOLS]
                self.uses[state] = {s: n for s, n in enumerate(follow[:SYMBOLS]) if n}
                for symbol in self.uses[state]:
                    longer = (prefix + int(steps[symbol])) % 2**64
                    if longer & PREFIX in prefixes:
                        below.append((self._new(state, symbol), longer))
            level, power = below, power * int(BASE) % 2**64
        self._infer(alpha)
        return self

    def _begin(self, symbols: int) -> None:
        self.symbols = symbols
        self.seen, self.ends = [0], [0]
        self.next: list[dict[int, int]] = [{}]
        self.uses: list[dict[int, int]] = [{}]

    def _new(self, state: int, symbol: int) -> int:
        to = len(self.seen)
        self.next[state][symbol] = to
        self.seen.append(0)
        self.ends.append(0)
        self.next.append({})
        self.uses.append({})
        return to

    def _infer(self, alpha: float) -> None:
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge_states()
        self._tabulate()
        del self.seen, self.ends, self.next, self.uses

    def _differ(self, hits: int, n: int, other_hits: int, m: int) -> bool:
        return abs(hits / n - other_hits / m) > self.bound * (n**-0.5 + m**-0.5)

    def _compatible(self, a: int, b: int) -> bool:
        """Do the two states end and go on alike, and those they lead to?"""
        todo, looked_at = [(a, b)], {(a, b)}
        while todo:
            x, y = todo.pop()
            n, m = self.seen[x], self.seen[y]
            if self._differ(self.ends[x], n, self.ends[y], m):
                return False
            for symbol in self.uses[x].keys() | self.uses[y].keys():
                if self._differ(self.uses[x].get(symbol, 0), n, self.uses[y].get(symbol, 0), m):
                    return False
                if symbol in self.next[x] and symbol in self.next[y]:
                    u, v = self.next[x][symbol], self.next[y][symbol]
                    if u != v and (u, v) not in looked_at:
                        looked_at.add((u, v))
                        todo.append((u, v))
        return True

    def _fold(self, into: int, tree: int) -> None:
        """Add the tree below a state to the automaton."""
        todo = [(into, tree)]
        while todo:
            x, y = todo.pop()
            self.seen[x] += self.seen[y]
            self.ends[x] += self.ends[y]
            for symbol, n in self.uses[y].items():
                self.uses[x][symbol] = self.uses[x].get(symbol, 0) + n
                to = self.next[y].get(symbol)
                if to is None:
                    continue
                if symbol in self.next[x]:
                    todo.append((self.next[x][symbol], to))
                else:
                    self.next[x][symbol] = to

    def _merge_states(self) -> None:
        settled = [0]
        fringe = [(0, s) for s in sorted(self.next[0])]
        while fringe:
            parent, symbol = fringe.pop(0)
            state = self.next[parent][symbol]
            if state in settled:
                continue
            for other in settled:
                if self._compatible(other, state):
                    self.next[parent][symbol] = other
                    self._fold(other, state)
                    break
            else:
                settled.append(state)
            known = set(settled)
            fringe = [
                (s, x) for s in settled for x in sorted(self.next[s]) if self.next[s][x] not in known
            ]
        self.states = settled

    def _tabulate(self) -> None:
        """Transitions and counts of the states; what was never seen leads to a state of even chances."""
        place = {s: i for i, s in enumerate(self.states)}
        n, k = len(self.states), self.symbols
        self.to = np.full((n + 1, k), n, np.int32)
        counts = np.zeros((n, k + 1))
        for s, i in place.items():
            counts[i, k] = self.ends[s]
            for symbol, uses in self.uses[s].items():
                counts[i, symbol] = uses
                self.to[i, symbol] = place[self.next[s][symbol]] if symbol in self.next[s] else 0
        self.reckon(counts)

    def reckon(self, counts: np.ndarray) -> None:
        """Take log2 chances from how often each state met each symbol, and last the end."""
        n, k = len(self.states), self.symbols
        met = counts[:, :k] > 0
        self.to[:n] = np.where(met, np.where(self.to[:n] == n, 0, self.to[:n]), n)
        bits = np.log2((counts + 0.5) / (counts.sum(1) + 0.5 * (k + 1))[:, None])
        self.cost = np.vstack([bits[:, :k], np.full((1, k), -math.log2(k + 1))])
        self.end = np.append(bits[:, k], -math.log2(k + 1))

    def moves(self, tokens: list[str], weights: np.ndarray) -> np.ndarray:
        """The weights of all tokens by state and symbol, and last the end.

        A move that the automaton lacks starts again at the first state.
        """
        n, k = len(self.states), self.symbols
        to = np.where(self.to == n, 0, self.to)
        size = np.array([len(t) for t in tokens], np.int64)
        symbols = classes_of("".join(tokens)).astype(np.int64)
        begin = np.cumsum(size) - size
        state = np.zeros(len(tokens), np.int64)
        out = np.zeros((n, k + 1), np.int64)
        going = np.arange(len(tokens))
        for j in range(int(size.max(initial=0))):
            going = going[size[going] > j]
            symbol = symbols[begin[going] + j]
            np.add.at(out, (state[going], symbol), weights[going])
            state[going] = to[state[going], symbol]
        np.add.at(out, (state, k), weights)
        return out

    def log_chances(self, tokens: list[str]) -> np.ndarray:
        """log2 of each token's chance, all tokens step by step together."""
        size = np.array([len(t) for t in tokens], np.int64)
        symbols = classes_of("".join(tokens)).astype(np.int64)
        begin = np.cumsum(size) - size
        state = np.zeros(len(tokens), np.int64)
        out = np.zeros(len(tokens))
        going = np.arange(len(tokens))
        for k in range(int(size.max(initial=0))):
            going = going[size[going] > k]
            symbol = symbols[begin[going] + k]
            out[going] += self.cost[state[going], symbol]
            state[going] = self.to[state[going], symbol]
        return out + self.end[state]


# ---- on Spark --------------------------------------------------------------


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list, list]]:
    """Ids, base spans and other tokens of the rows of a slice."""
    for batch in batches:
        for part in slices(batch, 1):
            texts = [t or "" for t in part.column(1).to_pylist()]
            base = [base_spans(t) for t in texts]
            yield part.column(0), base, [other_tokens(t, b) for t, b in zip(texts, base)]


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Credentials (stratum -1) and ordinary tokens; few of a task come twice."""
    held: set[tuple[int, str]] = set()
    size = 0

    def rows() -> pa.RecordBatch:
        columns = list(zip(*held)) if held else [()] * 2
        return pa.record_batch([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.string())], names=["stratum", "value"])

    for _, base, others in _found(batches):
        plain = list({value for row in others for _, value, whole in row if whole})
        held |= set(zip(strata(plain).tolist(), plain))
        held |= {(-1, value) for row in base for _, _, _, value in row}
        size += sum(map(len, plain))
        if len(held) > HELD or size > 80 * HELD:
            yield rows()
            held.clear()
            size = 0
    yield rows()


def _reduced(df: DataFrame, columns: str, values, schema: str) -> DataFrame:
    """Per slice of the tokens of ``df``, the columns that ``values`` makes of it and of ``columns``."""
    names = schema.replace(",", "").split()[::2]
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64()}
    types = [kinds[x] for x in schema.replace(",", "").split()[1::2]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                found = values(part.column(0).to_pylist(), *[c.to_numpy() for c in part.columns[1:]])
                yield pa.record_batch([pa.array(c, t) for c, t in zip(found, types)], names=names)

    return df.select("value", *columns.split()).mapInArrow(run, schema)


def _automaton(weighted: DataFrame, total: int) -> Automaton:
    """The automaton of all tokens of a table of value and weight, which add to about ``total``.

    Prefixes of a weight above UNIT have states of their own before the merge; of more than
    ``PREFIXES`` tokens, those that one in ``PREFIXES`` has.  Then every token goes through the
    automaton, and its moves count.
    """
    least = max(UNIT, total // PREFIXES)
    follow = [
        F.sum(F.when(F.col("key").bitwiseAND(15) == s, F.col("n")).otherwise(0)).alias(f"n{s}")
        for s in range(SYMBOLS + 1)
    ]
    found = (
        _reduced(weighted, "weight", prefix_moves, "key long, n long")
        .groupBy(F.shiftrightunsigned("key", 4).alias("prefix"))
        .agg(*follow)
        .where(" + ".join(f"n{s}" for s in range(SYMBOLS + 1)) + f" > {least}")
        .collect()
    )
    model = Automaton.of_prefixes({r[0]: [n / UNIT for n in r[1:]] for r in found})
    shared = weighted.sparkSession.sparkContext.broadcast(model)

    def moves(tokens: list[str], weights: np.ndarray):
        out = shared.value.moves(tokens, weights)
        state, symbol = np.nonzero(out)
        return state, symbol, out[state, symbol]

    sums = _reduced(weighted, "weight", moves, "state int, symbol int, n long")
    counts = np.zeros((len(model.states), SYMBOLS + 1))
    for r in sums.groupBy("state", "symbol").agg(F.sum("n").alias("n")).collect():
        counts[r["state"], r["symbol"]] = r["n"] / UNIT
    model.reckon(counts)
    return model


def _rates(likely: Automaton, tokens: list[str]) -> np.ndarray:
    return likely.log_chances(tokens) / np.array([len(t) + 1 for t in tokens])


def _unlabelled(likely: Automaton, credentials: DataFrame):
    """A test of tokens that may well be credentials which no pattern labels, and credentials' strata.

    Such tokens share a stratum with credentials, are not shorter than the shortest there, and
    their chance per character reaches the least one of a credential, or the mean less three
    standard deviations.
    """
    shared = credentials.sparkSession.sparkContext.broadcast(likely)

    def summary(tokens: list[str]):
        rates, size, of = _rates(shared.value, tokens), np.array([len(t) for t in tokens]), strata(tokens)
        fine = np.rint(rates * FINE).astype(np.int64)
        strata_here, at = np.unique(of, return_inverse=True)
        out = [np.full(len(strata_here), x) for x in (np.iinfo(np.int64).max, 0, 0, 0)]
        least = np.full(len(strata_here), np.inf)
        np.minimum.at(out[0], at, size)
        for total, x in zip(out[1:], (np.ones_like(fine), fine, fine * fine)):
            np.add.at(total, at, x)
        np.minimum.at(least, at, rates)
        return strata_here, *out, least

    summed = "stratum int, shortest long, n long, total long, squares long, least double"
    found = (
        _reduced(credentials, "", summary, summed)
        .groupBy("stratum")
        .agg(F.min("shortest"), F.sum("n"), F.sum("total"), F.sum("squares"), F.min("least"))
        .collect()
    )
    shortest = np.full(1 << SYMBOLS, np.iinfo(np.int64).max)
    for r in found:
        shortest[r[0]] = r[1]
    n, total, squares = (sum(r[i] for r in found) for i in (2, 3, 4))
    mean = total / n / FINE
    spread = math.sqrt(max(0.0, squares / n / FINE**2 - mean**2))
    floor = min(min(r[5] for r in found), mean - 3 * spread)

    def alike(tokens: list[str]) -> np.ndarray:
        if not tokens:
            return np.zeros(0, bool)
        long_enough = np.array([len(t) for t in tokens]) >= shortest[strata(tokens)]
        return long_enough & (_rates(shared.value, tokens) >= floor)

    return alike, np.array([r[0] for r in found])


def _learn(
    tokens: DataFrame, counts: dict[int, int], most: int, least_bits: float, rare: float, seed: int
) -> tuple[Automaton, Automaton, np.ndarray]:
    """Automata of credentials and ordinary tokens, and the bits that a token of each stratum needs.

    ``counts`` has the distinct tokens of each stratum, -1 for credentials.  Tokens like
    credentials are left out of ordinary ones, but in strata where they are more than a share
    ``rare`` of all those they count as ordinary.  The automaton of ordinary tokens learns
    from every other one of each stratum.  In strata without a credential a token must also
    beat all ordinary ones that were held out.
    """
    spark = tokens.sparkSession
    credentials = tokens.where("stratum < 0").select("value", F.lit(UNIT).cast("long").alias("weight"))
    likely = _automaton(credentials, counts[-1] * UNIT)
    alike, of_credentials = _unlabelled(likely, credentials)

    ordinary = tokens.where("stratum >= 0")
    n_of = np.zeros(1 << SYMBOLS, np.int64)
    for stratum, n in counts.items():
        if stratum >= 0:
            n_of[stratum] = n

    def hidden(values: list[str], of: np.ndarray):
        found = np.bincount(of[alike(values)], minlength=1 << SYMBOLS)
        return np.flatnonzero(found), found[found > 0]

    n_alike = np.zeros(1 << SYMBOLS, np.int64)
    for r in _reduced(ordinary, "stratum", hidden, "stratum int, n long").groupBy("stratum").agg(F.sum("n")).collect():
        n_alike[r[0]] = r[1]
    common = n_alike > rare * n_of.sum()

    def shown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                gone = alike(part.column(1).to_pylist()) & ~common[part.column(0).to_numpy()]
                yield part.filter(pa.array(~gone))

    # every stratum weighs as many tokens at most; places are numbered in cells of about as many
    each = max(8, most // max(1, np.count_nonzero(n_of)))
    left = n_of - np.where(common, 0, n_alike)
    law = [(int(s), int(-(-left[s] // each)), max(1, round(UNIT * min(1.0, each / left[s])))) for s in np.flatnonzero(left)]
    mixed = F.xxhash64(F.lit(seed), "value")
    cell = F.pmod(F.xxhash64("value", F.lit(seed)), F.col("cells"))
    split = (
        ordinary.mapInArrow(shown, "stratum int, value string")
        .join(F.broadcast(spark.createDataFrame(law, "stratum int, cells long, weight long")), "stratum")
        .withColumn("place", F.row_number().over(Window.partitionBy("stratum", cell).orderBy(mixed, "value")))
    )
    split = keep_table(split.select("stratum", "value", "weight", (F.col("place") % 2 == 1).alias("taught")), "secret-ordinary")
    plain = _automaton(split.where("taught"), each * len(law) * UNIT)

    shared = spark.sparkContext.broadcast((likely, plain))

    def highest(values: list[str], of: np.ndarray):
        one, other = shared.value
        found = np.full(1 << SYMBOLS, -np.inf)
        np.maximum.at(found, of, one.log_chances(values) - other.log_chances(values))
        at = np.flatnonzero(np.isfinite(found))
        return at, found[at]

    needed = np.full(1 << SYMBOLS, least_bits)
    held_out = _reduced(split.where("not taught"), "stratum", highest, "stratum int, bits double")
    for r in held_out.groupBy("stratum").agg(F.max("bits")).collect():
        needed[r[0]] = max(least_bits, np.nextafter(r[1], np.inf))  # more than the largest
    needed[of_credentials] = least_bits
    drop_table(split)
    return likely, plain, needed


def _judge(models):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        credential, ordinary, needed = models.value or (None, None, None)
        for ids, base, others in _found(batches):
            tokens = list({value for row in others for _, value, _ in row})
            likely: set[str] = set()
            if credential is not None:
                bits = credential.log_chances(tokens) - ordinary.log_chances(tokens)
                likely = {tokens[j] for j in np.flatnonzero(bits >= needed[strata(tokens)])}
            out = []
            for row, rest in zip(base, others):
                spans = [(s, k, e) for s, k, e, _ in row]
                more = [(s, 3, s + len(v)) for s, v, _ in rest if v in likely]
                text = [",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(x)) for x in (spans, spans + more)]
                kinds = [k for _, k, _ in spans]
                sha = hashlib.sha256(text[0].encode()).hexdigest()
                out.append((*(kinds.count(k) for k in range(3)), sha, text[1], len(more)))
            columns = list(zip(*out)) if out else [()] * 6
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.record_batch(
                [ids, *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_format"],
            )

    return run


def scan_secrets(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_labelled: int = 2000,
    least_labelled: int = 10,
    least_bits: float = 20.0,
    rare: float = 0.02,
    seed: int = 1,
) -> DataFrame:
    """Per row doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_format.

    ``spans`` lists ``kind:start:end`` of base and learned (``format``) spans, by start and
    then kind, in code points; ``base_sha256`` is the hash of the base ones so listed.  The
    automata learn from all distinct credentials and all distinct ordinary tokens that touch no
    base span (``_learn``).  Ordinary tokens weigh the same in all strata, as ``most_labelled``
    together (8 of each stratum at least).  Every other ordinary one is
    held out, and those that look like credentials are no lesson if they are ``rare`` among all
    tokens.  A token outside base spans, or a piece
    that they leave of one (without the marks ``+/_.=-`` at the cut), of 6 characters at least
    is a ``format`` span if it is ``2 ** least_bits`` times likelier as a credential than as
    an ordinary token.

    Null or empty text has no spans.  With fewer than ``least_labelled`` distinct credentials
    there are no ``format`` spans.  A null id is kept, repeated rows give repeated results, an empty table none, other
    columns are left out.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = texts.mapInArrow(_tokens, "stratum int, value string")
    tokens = keep_table(found.distinct(), "secret-tokens")
    counts = {r[0]: r[1] for r in tokens.groupBy("stratum").count().collect()}
    models = None
    if counts.get(-1, 0) >= least_labelled:
        models = _learn(tokens, counts, most_labelled, least_bits, rare, seed)
    drop_table(tokens)
    return texts.mapInArrow(
        _judge(spark.sparkContext.broadcast(models)),
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
        "spans string, n_format long",
    )


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(documents(spark, sf_dir))


QUERIES = {"op2_secret_scan": op2_secret_scan}
SQL: dict[str, str] = {}
