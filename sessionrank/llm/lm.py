"""Language-model scoring: a weighted backoff automaton over the bytes of lower-cased tokens.

A text is its tokens, joined by single spaces, and an end mark. The model is an n-gram model of that byte
sequence with Witten-Bell smoothing in backoff form: contexts are states, seen continuations are arcs,
and where no arc fits, the failure arc to the next shorter context adds its weight. Every n-gram seen is an
arc at any size: the n-grams are a partitioned table (Arcs). Texts are scored in blocks: a block asks the table for
the arcs and failure arcs that its runs of bytes can take, builds the automaton of these, and reads its texts from left to right.
"""

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from sessionrank.llm.common import LOWER_BYTES, PIECE_BYTES, flat_map, map_texts, pieces, stage, texts_of

ORDER = 6
# Texts of together so many bytes (or a single longer one) share an automaton.
BLOCK_BYTES = 1 << 25
# A word is looked up in memory if it has this share of all tokens (so at most 1 / share words), else by a join.
HEAD_SHARE = 1 / 1_000_000

_HELD_ENTRIES = 500_000
_LANE = 256
# Runs that share a row of paths, at most, so that rows stay below half a megabyte.
_ROW_RUNS = 1 << 13
_PAIR = 0xFFFF
_PART_BITS = 33  # monotonically increasing ids hold the partition above these bits
_MIX = np.uint64(0x9E3779B97F4A7C15)


def tokens_of(text):
    """The lower-cased tokens of a text given as bytes."""
    return text.translate(LOWER_BYTES).split()


def sequence(words, order):
    """The bytes that the model reads: `order - 1` end marks, the tokens, an end mark."""
    return b"\n" * (order - 1) + b" ".join(words) + b"\n"


# ---------------------------------------------------------------- counts

def word_counts(docs, text="text"):
    """Rows (word binary, n): how often each token occurs; the end of a text is the empty word."""
    def make():
        held = Counter()

        def out():
            rows = [list(held), list(held.values())]
            held.clear()
            return rows

        def each(batch):
            for t in texts_of(batch.column(0)):
                held.update(tokens_of(t))
                held[b""] += 1
            return out() if len(held) > _HELD_ENTRIES else None

        return each, out

    counts = flat_map(docs.select(text), "word binary, n bigint", make)
    return counts.groupBy("word").agg(F.sum("n").alias("n"))


def ngram_counts(docs, text="text", order=ORDER):
    """Rows (gram, n): how often each run of `order` bytes occurs; gram holds the bytes, the last one lowest."""
    def make():
        held = Runs(order)

        def each(batch):
            full = False
            for part in _parts([b" ".join(tokens_of(t)) for t in texts_of(batch.column(0))]):
                full |= held.add(part)
            return held.out() if full else None

        return each, held.out

    counts = flat_map(docs.select(text), "gram bigint, n bigint", make)
    return counts.groupBy("gram").agg(F.sum("n").alias("n"))


class Runs:
    """Distinct runs of `order` bytes and how often they occurred, as sorted arrays."""

    def __init__(self, order):
        self.order, self.held = order, []

    def add(self, bodies):
        """Counts the runs of joined texts; true if many distinct ones are held by now."""
        self.held.append(np.unique(_grams([sequence([t], self.order) for t in bodies], self.order), return_counts=True))
        if sum(len(k) for k, _ in self.held) > 4 * _HELD_ENTRIES:
            self._merge()
            return len(self.held[0][0]) > 2 * _HELD_ENTRIES
        return False

    def _merge(self):
        keys, n = (np.concatenate(x) for x in zip(*self.held))
        sort = np.argsort(keys, kind="stable")
        keys, n = keys[sort], n[sort]
        first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]) != 0)
        self.held = [(keys[first], np.add.reduceat(n, first) if len(first) else n)]

    def out(self):
        """What is held, as columns (gram, n), and nothing is held any more."""
        if not self.held:
            return None
        self._merge()
        (keys, n), self.held = self.held[0], []
        return [pa.array(keys.view(np.int64)), pa.array(n)]


def _parts(texts):
    """Consecutive lists of texts, each of about PIECE_BYTES or a single longer text."""
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size > PIECE_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def _windows(raw):
    """The 8 bytes up to each byte, as numbers."""
    buf = np.frombuffer(b"\0" * 7 + raw, np.uint8)
    return np.ndarray((len(raw),), ">u8", buf, strides=(1,))


def _grams(sequences, order):
    """The runs of `order` bytes that end at each byte of the sequences after the leading end marks."""
    raw = b"".join(sequences)
    size = np.fromiter(map(len, sequences), np.int64, len(sequences))
    grams = _windows(raw).astype(np.uint64) & _mask(order)
    inner = np.ones(len(raw), bool)
    starts = np.cumsum(size) - size
    for k in range(order - 1):
        inner[starts + k] = False
    return grams[inner]


def _mask(length):
    return np.uint64((1 << 8 * length) - 1)


# ---------------------------------------------------------------- model

def fit(docs, text="text", order=ORDER):
    """Arcs of the byte sequences of all texts of `docs`: every n-gram of at most `order` (2 to 8) bytes that occurs."""
    return Arcs(stage(ngram_counts(docs, text, order), "ngrams"), order)


class Arcs:
    """The arcs and failure arcs of the automaton, from a table (gram, n) of the counts of runs of `order` bytes.

    With all n-grams kept, the backoff form is p(b | h) = (n(hb) + t(h) p(b | h')) / (c(h) + t(h)), where h' is h without
    its first byte, c counts h, t the different bytes after it; the failure arc from h to h' weighs t(h) / (c(h) + t(h)).
    Single bytes are smoothed by adding one, so all of them have arcs. Runs that share the two bytes before the last one need
    nothing from others but the counts of pairs, 65,536 numbers: they make up a group, groups are dealt out to tasks.
    """

    def __init__(self, counts, order):
        self.counts, self.order = counts, order
        pair = F.col("gram").bitwiseAND(F.lit(_PAIR)).cast("int").alias("pair")
        n = np.zeros(_PAIR + 1)
        for p, k in counts.groupBy(pair).agg(F.sum("n")).collect():  # 65,536 rows at most
            n[p] = k
        self.pairs = n.reshape(256, 256)
        self.total = int(n.sum())
        self.low = (self.pairs.sum(0) + 1) / (self.total + 256)

    def paths(self, asked):
        """Rows (block, grams, lengths, logps, sizes, weights): how the runs of `asked`, rows (block, near, grams), are read.

        Up to _ROW_RUNS runs share a row, their numbers packed. For each run, `lengths` has that of its longest suffix that occurs, and
        `logps` the log10 probability of the arc that reads its last byte; `weights` has the log10 weights of the failure arcs that lead
        there (`sizes` tells how many), from the contexts of `length` bytes on as far as longer ones occur. `near` is the group of all
        runs of a row of `asked`. A task holds the counted runs of a group; asked runs stream by.
        """
        order, pairs = self.order, self.counts.sparkSession.sparkContext.broadcast((self.pairs, self.low))
        near = F.shiftright("gram", 8).bitwiseAND(F.lit(_PAIR)).cast("int")
        rows = self.counts.select(near.alias("near"), F.lit(-1).cast("bigint").alias("block"), "gram", "n", F.lit(None).cast("binary").alias("grams"))
        none = F.lit(0).cast("bigint")
        rows = rows.unionAll(asked.select("near", "block", none, none, "grams"))

        grouped = rows.repartition("near").sortWithinPartitions("near", F.col("block") >= 0)
        return flat_map(grouped, "block bigint, grams binary, lengths binary, logps binary, sizes binary, weights binary", lambda: _smoothing(order, *pairs.value))


def _smoothing(order, pairs, low):
    """What a task of `Arcs.paths` does: (each, last) of the batches of its rows."""
    seen, ask = [], []  # (near, gram, n) and (block, gram)
    # Smoothing takes some hundred bytes a run, so fewer runs are smoothed at a time than are held elsewhere.
    fresh, most = [0], _HELD_ENTRIES // 4

    def some(tail):
        """The paths of what is asked; the counted runs of the group `tail` are kept."""
        near, gram, n = (np.concatenate([s[i] for s in seen] or [np.zeros(0)]) for i in range(3))
        last = near == tail
        seen[:] = [(near[last], gram[last], n[last])] if last.any() else []
        fresh[0] = 0
        if not ask:
            return None
        block, asked = (np.concatenate(x) for x in zip(*ask))
        ask.clear()
        sort = np.argsort(block, kind="stable")
        block, asked = block[sort], asked[sort]
        length, logp, weight = _paths(gram.astype(np.uint64), n, asked, order, pairs, low)
        known = ~np.isnan(weight)
        size = known.sum(1)
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
        cuts = [c for a, b in zip(cuts, cuts[1:]) for c in range(a, b, _ROW_RUNS)] + [len(block)]
        spans = [slice(a, b) for a, b in zip(cuts, cuts[1:])]
        return [
            block[cuts[:-1]].tolist(), [_pack(asked[x]) for x in spans], [length[x].astype(np.uint8).tobytes() for x in spans],
            [_pack(logp[x]) for x in spans], [size[x].astype(np.uint8).tobytes() for x in spans], [_pack(weight[x][known[x]]) for x in spans],
        ]

    def each(batch):
        sizes = np.maximum(pc.fill_null(pc.binary_length(batch.column(4)), 8).to_numpy(zero_copy_only=False).astype(np.int64) // 8, 1)
        part = np.cumsum(sizes) // max(1, most // 4)
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        made = [rows for a, b in zip(cuts, cuts[1:]) if b > a and (rows := slice_of(batch.slice(a, b - a)))]
        return [sum(columns, []) for columns in zip(*made)] if made else None

    def slice_of(batch):
        near, block, gram, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        counted = block < 0
        if counted.any():
            seen.append((near[counted], gram[counted].view(np.uint64), n[counted]))
        for i in np.flatnonzero(~counted).tolist():
            grams = _unpack(batch.column(4)[i].as_buffer(), np.uint64)
            ask.append((np.full(len(grams), block[i]), grams))
            fresh[0] += len(grams)
        fresh[0] += int(counted.sum())
        return some(near[-1]) if fresh[0] > max(most, 2 * len(seen[0][0]) if seen else 0) else None

    return each, lambda: some(-1)


def _pack(numbers):
    """Numbers of 8 bytes as bytes: all first ones, all second ones and so on, which compresses well."""
    return numbers.view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpack(packed, kind):
    return np.frombuffer(packed, np.uint8).reshape(8, -1).T.copy().view(kind).ravel()


def _paths(gram, n, asked, order, pairs, low):
    """For runs `asked`, given all counted runs of their groups: length, log10 probability, log10 weights.

    Column j of the weights is the failure arc of the context of j bytes, where it is followed; elsewhere there is no number.
    """
    keys, at = np.unique(np.concatenate([gram, asked]), return_inverse=True)
    count = np.bincount(at[:len(gram)], n, len(keys))
    pair = (keys & np.uint64(_PAIR)).astype(np.int64)
    length, arc = np.ones(len(keys), np.int64), low[pair & 255]
    p, weight = arc, np.full((len(keys), order), np.nan)
    for k in range(2, order + 1):
        if k == 2:
            seen, c, t = pairs.ravel()[pair], pairs.sum(1)[pair >> 8], (pairs > 0).sum(1)[pair >> 8]
        else:
            runs, run = np.unique(keys & _mask(k), return_inverse=True)
            counts = np.bincount(run, count, len(runs))
            contexts, of = np.unique(runs >> np.uint64(8), return_inverse=True)
            c, t = (np.bincount(of, x, len(contexts))[of][run] for x in (counts, counts > 0))
            seen = counts[run]
        here = seen > 0
        p = np.where(c > 0, (seen + t * p) / np.maximum(c + t, 1), p)
        length, arc = np.where(here, k, length), np.where(here, p, arc)
        fails = (c > 0) & ~here
        weight[fails, k - 1] = np.log10(t[fails] / (c[fails] + t[fails]))
    at = at[len(gram):]
    return length[at], np.log10(arc[at]), weight[at]


class Automaton:
    """The states, arcs and failure arcs that the runs of some texts can take.

    A state is a context, numbered by length and bytes; 0 is the empty one, which has an arc for every byte. An open-addressed
    table by (state, byte) has the numbers of the arcs, so that its free slots are small; each state has a failure arc to the next shorter context. An arc leads to the longest
    context that its bytes end in.
    """

    def __init__(self, order, low, gram, length, logp, size, weights):
        """From single bytes' probabilities and the paths of runs: `size` weights of each, one after another."""
        self.order, self.failures = order, 0
        ends = np.cumsum(size, dtype=np.int64)
        keys, logps, self.contexts, weight = [np.arange(256, dtype=np.uint64)], [np.log10(low)], [np.zeros(1, np.uint64)], [np.zeros(1)]
        for m in range(1, order):
            past = (length <= m + 1) & (m < length + size)  # the state, or passed by a failure arc
            context = (gram >> np.uint64(8)) & _mask(m)
            self.contexts.append(np.unique(context[past]))
            fails = np.flatnonzero(past & (length <= m))
            own = np.zeros(len(self.contexts[m]))
            own[np.searchsorted(self.contexts[m], context[fails])] = weights[(ends - size)[fails] + m - length[fails]]
            weight.append(own)
            arcs = np.flatnonzero(length == m + 1)
            arc, first = np.unique(gram[arcs] & _mask(m + 1), return_index=True)
            keys.append(arc)
            logps.append(logp[arcs][first])
        self.lead = np.cumsum([0, *map(len, self.contexts)])
        self.weight = np.concatenate(weight)
        self.fail = np.concatenate([np.zeros(1, np.int64), *[self.state(self.contexts[m], m - 1) for m in range(1, order)]])
        source = np.concatenate([
            np.zeros(256, np.int64), *[self.lead[m] + np.searchsorted(self.contexts[m], keys[m] >> np.uint64(8)) for m in range(1, order)]
        ])
        target = np.concatenate([self.state(keys[k - 1], min(k, order - 1)) for k in range(1, order + 1)])
        byte = np.concatenate([k & np.uint64(255) for k in keys]).astype(np.int64)
        self._table(source << 8 | byte, target, np.concatenate(logps))

    def state(self, grams, length):
        """The state of the longest suffix of each gram's last `length` bytes that is a context."""
        out = np.zeros(len(grams), np.int64)
        for m in range(1, length + 1):
            if len(self.contexts[m]):
                cut = grams & _mask(m)
                at = np.minimum(np.searchsorted(self.contexts[m], cut), len(self.contexts[m]) - 1)
                out = np.where(self.contexts[m][at] == cut, self.lead[m] + at, out)
        return out

    def _table(self, arcs, target, logp):
        self.bits = max(10, int(4 * len(arcs)).bit_length())
        size, none = 1 << self.bits, len(arcs)
        # A row (arc, state it leads to, probability) for each arc; a free slot has the number of a last one, which no arc equals.
        self.arcs = np.stack([np.append(arcs, -1), np.append(target, 0), np.append(logp, 0.0).view(np.int64)], 1)
        self.slot = np.full(size, none, np.int32)
        at, todo = self._home(arcs), np.arange(none, dtype=np.int32)
        while len(todo):
            free = self.slot[at] == none
            self.slot[at[free]] = todo[free]  # of several, one is written
            left = self.slot[at] != todo
            todo, at = todo[left], (at[left] + 1) & (size - 1)

    def _home(self, arcs):
        return ((arcs.view(np.uint64) * _MIX) >> np.uint64(64 - self.bits)).view(np.int64)

    def step(self, state, byte):
        """The states after a byte and the log10 probabilities: failure arcs, whose weights add up, until an arc fits."""
        arc = state << 8 | byte
        place = self._home(arc)
        found, after, logp = self.arcs.take(self.slot.take(place), 0).T
        logp = logp.view(np.float64)
        todo = np.flatnonzero(found != arc)
        at, arc, place, gain = state[todo], arc[todo], place[todo], np.zeros(len(todo))
        while len(todo):
            found, target, reached = self.arcs.take(self.slot.take(place), 0).T
            fits, fails = found == arc, found < 0
            done = todo[fits]
            after[done], logp[done] = target[fits], gain[fits] + reached.view(np.float64)[fits]
            self.failures += int(fails.sum())
            gain[fails] += self.weight[at[fails]]
            at[fails] = self.fail[at[fails]]
            arc[fails] = at[fails] << 8 | byte[todo[fails]]
            place = np.where(fails, self._home(arc), (place + 1) & ((1 << self.bits) - 1))
            todo, at, arc, place, gain = (x[~fits] for x in (todo, at, arc, place, gain))
        return after, logp

    def scores(self, bodies):
        """The log10 probability of each text, given as joined tokens.

        Texts are read from left to right, many side by side. A long one is cut into lanes: a lane starts in the state
        that the `order - 1` bytes before it lead to, whatever was read before them.
        """
        lead = self.order - 1
        parts = [sequence([t], self.order) for t in bodies]
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        raw = b"".join(parts)
        buf, before = np.frombuffer(raw, np.uint8), _windows(raw)
        starts = np.cumsum(size) - size
        lanes = -(-(size - lead) // _LANE)
        doc = np.repeat(np.arange(len(parts)), lanes)
        rank = np.arange(len(doc)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        first = starts[doc] + lead + rank * _LANE
        length = np.minimum(first + _LANE, (starts + size)[doc]) - first
        sort = np.argsort(-length, kind="stable")  # longest first: finished lanes lie at the end
        doc, first, length = doc[sort], first[sort], length[sort]
        state, score = self.state(before[first - 1].astype(np.uint64) & _mask(lead), lead), np.zeros(len(doc))
        for i in range(int(length[0])):
            on = int(np.searchsorted(-length, -i, "left"))
            state[:on], gain = self.step(state[:on], buf.take(first[:on] + i).astype(np.int64))
            score[:on] += gain
        return np.bincount(doc, score, len(parts))


# ---------------------------------------------------------------- scoring

def score(docs, arcs, words, keep=("doc_id",), text="text", head_share=HEAD_SHARE):
    """Rows (keep..., n_tokens, n_known, train_tokens, base_score, score), one for each document row.

    `arcs` are Arcs, `words` the training word counts (word, n). base_score adds
    log10((c + 1) / (N + V + 1)) over the tokens and the end (c: the token's count, N: all, V: distinct);
    score adds the log10 probabilities of the text's bytes, as the automaton of its block reads them. Frequent words are looked
    up in a broadcast table of at most 1 / head_share words; all others, seen in training or not, are joined with the counts.

    A null text is empty: its only token is the end. Repeated rows are scored one by one. Other columns
    of the tables play no part. Without any training text N and V are 0 and all bytes equally likely.
    """
    spark = docs.sparkSession
    total, types = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    head = words.filter(F.col("n") >= F.lit(total * head_share))
    sent = spark.sparkContext.broadcast({bytes(w): n for w, n in head.collect()})
    order, low = arcs.order, arcs.low

    def make():
        known, block = sent.value, [None, 0]  # its number and bytes

        def each(texts, batch):
            rows = batch.column(0).to_numpy()
            texts = [tokens_of(t) for t in texts]
            bodies, blocks = [b" ".join(t) for t in texts], []
            for row, body in zip(rows, bodies):
                if block[0] is None:
                    block[0] = int(row) >> _PART_BITS << _PART_BITS
                elif block[1] + len(body) > BLOCK_BYTES:
                    block[:] = [block[0] + 1, 0]
                block[1] += len(body) + 1
                blocks.append(block[0])
            n, cuts, found, uses = [len(t) + 1 for t in texts], [0], [], []
            offsets, rare, times = [0], [], []
            for t in texts:
                counts = Counter(t)
                counts[b""] = 1
                for w, k in counts.items():
                    c = known.get(w)
                    if c is None:
                        rare.append(w)
                        times.append(k)
                    else:
                        found.append(c)
                        uses.append(k)
                cuts.append(len(found))
                offsets.append(len(rare))
            terms = np.array(uses, np.float64) * np.log10(np.array(found, np.float64) + 1)
            seen = [sum(uses[a:b]) for a, b in zip(cuts, cuts[1:])]
            logs = [float(terms[a:b].sum()) for a, b in zip(cuts, cuts[1:])]
            items = pa.StructArray.from_arrays([pa.array(rare, pa.binary()), pa.array(times, pa.int32())], ["word", "k"])
            return [n, seen, logs, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items), blocks, bodies]

        return each

    names = [f"c{i}" for i in range(len(keep))]
    source = docs.select(F.monotonically_increasing_id().alias("row"), *[F.col(f"`{k}`").alias(n) for k, n in zip(keep, names)], F.col(f"`{text}`").alias("words"))
    fields = "n_tokens bigint, seen bigint, logs double, rare array<struct<word:binary,k:int>>, block bigint, body binary"
    found = stage(map_texts(source, "words", ["row", *names], fields, make), "blocks")
    tail = (
        found.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.k").join(words, "word")
        .groupBy("row").agg(F.sum("k").alias("more"), F.sum(F.col("k") * F.log10(F.col("n") + 1.0)).alias("more_logs"))
    )
    read = found.select("block", "row", *names, "n_tokens", "seen", "logs", "body")
    schema = read.drop("block", "body").schema.add("score", "double")

    def read_blocks(batches):
        """A block's paths come first, then its texts stream by: neither is held as a whole table."""
        block, paths, model = None, [], None
        for batch in batches:
            blocks, is_text = batch.column("block").to_numpy(), batch.column("body").is_valid().to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero((np.diff(blocks) != 0) | np.diff(is_text)) + 1).tolist(), len(blocks)]
            for a, b in zip(cuts, cuts[1:]):
                if b == a:
                    continue
                if blocks[a] != block:
                    block, paths, model = blocks[a], [], None
                if not is_text[a]:
                    paths.append(_columns(batch.slice(a, b - a)))
                    continue
                if model is None:
                    model, paths = Automaton(order, low, *map(np.concatenate, zip(*paths))), []
                for piece in pieces(batch.slice(a, b - a), batch.schema.get_field_index("body")):
                    score = pa.array(model.scores(texts_of(piece.column("body"))))
                    yield pa.RecordBatch.from_arrays([*(piece.column(n) for n in schema.names[:-1]), score], names=schema.names)

    paths = arcs.paths(_asked(found, order))
    mixed = read.unionByName(paths, allowMissingColumns=True)
    scored = mixed.repartition("block").sortWithinPartitions("block", F.col("body").isNotNull()).mapInArrow(read_blocks, schema)
    zero = F.lit(0)
    return scored.join(tail, "row", "left").select(
        *[F.col(n).alias(k) for n, k in zip(names, keep)],
        "n_tokens",
        (F.col("seen") + F.coalesce("more", zero)).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", zero.cast("double"))
         - F.col("n_tokens") * F.log10(F.lit(float(total + types + 1)))).alias("base_score"),
        "score",
    )


def _asked(found, order):
    """Rows (block, near, grams): the runs of `order` bytes in the texts of each block, packed by their two bytes before the last.

    They are distinct but where a block's rows are read by two tasks or it has very many of them.
    """
    def make():
        held, block = Runs(order), [None]

        def out():
            made = held.out()
            return made and _grouped(block[0], made[0].to_numpy().view(np.uint64))

        def each(batch):
            rows = []
            blocks, bodies = batch.column(0).to_numpy(), texts_of(batch.column(1))
            cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    if blocks[a] != block[0]:
                        rows.append(out())
                        block[0] = int(blocks[a])
                    for part in _parts(bodies[a:b]):
                        if held.add(part):
                            rows.append(out())
            rows = [r for r in rows if r]
            return [sum(c, []) for c in zip(*rows)] if rows else None

        return each, out

    return flat_map(found.select("block", "body"), "block bigint, near int, grams binary", make)


def _grouped(block, grams):
    """The columns of `_asked` for runs of a block."""
    near = ((grams >> np.uint64(8)) & np.uint64(_PAIR)).astype(np.int64)
    sort = np.argsort(near, kind="stable")
    near, grams = near[sort], grams[sort]
    cuts = [0, *(np.flatnonzero(np.diff(near)) + 1).tolist(), len(near)]
    return [[block] * (len(cuts) - 1), near[cuts[:-1]].tolist(), [_pack(grams[a:b]) for a, b in zip(cuts, cuts[1:])]]


def _columns(paths):
    """Of a table of paths: grams, lengths, log10 probabilities, numbers of weights, and the weights one after another."""
    kinds = {"grams": np.uint64, "lengths": np.uint8, "logps": np.float64, "sizes": np.uint8, "weights": np.float64}
    out = []
    for name, kind in kinds.items():
        packed = paths.column(name).to_pylist()
        if kind is np.uint8:
            out.append(np.frombuffer(b"".join(packed), np.uint8))
        else:
            out.append(np.concatenate([_unpack(x, kind) for x in packed]))
    return out
