"""Language ID: script ranges narrow the candidates, Viterbi over per-word scores labels spans of mixed text."""

import bisect
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import functions as F

from sessionrank.llm.common import flat_map, map_texts, table_sizes, texts_of

UNKNOWN = "und"
LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")

# The fit reads about so many rows of each language, chosen by a hash of the row; it needs no more.
SAMPLE_ROWS = 4000
# So many languages are learned, those with the most rows: what bounds the model's memory (a quarter of a megabyte each).
MAX_LANGUAGES = 500
BUCKETS = 1 << 16
SMOOTHING = 0.5
# Cost (natural log) of changing the language from one word to the next.
SWITCH = 16.0
# A script belongs to a language if it has this share of its words; words in other scripts cost so much.
SCRIPT_SHARE, WRONG_SCRIPT = 0.01, 40.0
_CHUNK = 64
_KNOWN_WORDS = 200_000
_CELLS = 1 << 23

# First code points of blocks, in order, and the script from there on.
SCRIPTS = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"),
    (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Oriya"), (0x0B80, "Tamil"),
    (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"),
    (0x0F00, "Tibetan"), (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x1780, "Khmer"),
    (0x1800, "Mongolian"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"), (0x3040, "Kana"), (0x3100, "Other"),
    (0x3400, "Han"), (0xA000, "Other"), (0xAC00, "Hangul"), (0xD800, "Other"), (0xF900, "Han"), (0xFB00, "Latin"),
    (0xFB13, "Armenian"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFE00, "Other"), (0xFE70, "Arabic"), (0xFF00, "Latin"),
    (0xFF66, "Kana"), (0xFFA0, "Hangul"), (0xFFDD, "Other"), (0x20000, "Han"), (0x30000, "Other"),
)
_CHUNK_BYTES = bytes(b + 32 if 65 <= b < 91 else b if b > 127 or 97 <= b < 123 else 32 for b in range(256))
_FIRST = [a for a, _ in SCRIPTS]
SCRIPT_NAMES = sorted({s for _, s in SCRIPTS})
_SCRIPT = [SCRIPT_NAMES.index(s) for _, s in SCRIPTS]


def script_of(word):
    """Number of the script of the first letter of a word given as bytes."""
    if word[0] < 128:
        return _SCRIPT[0]
    word = word.decode()
    return _SCRIPT[bisect.bisect_right(_FIRST, ord(word[0])) - 1]


def chunks_of(text):
    """What stands between ASCII characters that are no letters, ASCII letters in lower case, of a text given as bytes."""
    return text.translate(_CHUNK_BYTES).split()


def words_of(chunk):
    """The runs of letters in a chunk, in lower case: itself, or several or none around other characters."""
    if chunk.isascii():
        return [chunk] if chunk else []
    return [w.encode() for w in LETTERS.findall(chunk.decode("utf-8", "replace").lower())]


def trigrams(words):
    """Buckets of the byte trigrams of all words (each between spaces), and their numbers per word."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    buf = np.frombuffer(b" " + b"  ".join(words) + b" ", np.uint8).astype(np.uint32)
    value = buf[:-2] << 16 | buf[1:-1] << 8 | buf[2:]
    inner = np.ones(len(value) + 2, bool)
    past = np.cumsum(size + 2)
    inner[past - 1] = inner[past - 2] = False  # those would reach into the next word
    value = value[inner[:-2]]
    return ((value * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64), size


class _Numbers(dict):
    """Numbers keys in the order of their first lookup."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


class Model:
    def __init__(self, languages, counts, scripts, priors):
        """counts: (BUCKETS, languages) of trigrams; scripts: (scripts, languages) of words; priors: rows of each."""
        self.languages = languages
        share = scripts / np.maximum(scripts.sum(0), 1)
        used = share >= SCRIPT_SHARE
        # scripts that no language uses tell nothing
        self.script = np.where(used | ~used.any(1, keepdims=True), 0.0, -WRONG_SCRIPT)
        logs = np.log((counts + SMOOTHING) / (counts.sum(0) + SMOOTHING * BUCKETS))
        self.logs = (logs - logs.max(1, keepdims=True, initial=-np.inf if languages else 0)).astype(np.float32)
        self.priors = np.log((priors + 1) / (priors.sum() + len(priors)))
        self._forget()

    def learned(self):
        """What was learned, as plain values."""
        return {k: v for k, v in vars(self).items() if k not in ("known", "rows", "letters")}

    @classmethod
    def of(cls, learned):
        model = cls.__new__(cls)
        vars(model).update(learned)
        model._forget()
        return model

    def _forget(self):
        self.known = _Numbers()
        self.rows, self.letters = np.zeros((0, len(self.languages)), np.float32), np.zeros(0, np.int64)

    def word_scores(self, chunks):
        """Scores (chunks, languages) and the numbers of letters; a chunk without letters has none and scores 0."""
        if len(self.known) > _KNOWN_WORDS:
            self._forget()
        before = len(self.known)
        ids = np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))
        new = list(islice(self.known, before, None))
        if new:
            parts = [words_of(c) for c in new]
            words = [w for p in parts for w in p]
            rows, letters = np.zeros((len(new), len(self.languages)), np.float32), np.zeros(len(new), np.int64)
            if words:
                buckets, size = trigrams(words)
                first = np.cumsum(size) - size
                scores = np.add.reduceat(self.logs[buckets], first) + self.script[[script_of(w) for w in words]]
                count = np.array([len(w) if w.isascii() else len(w.decode()) for w in words])
                many = np.fromiter(map(len, parts), np.int64, len(parts))
                some = many > 0
                lead = (np.cumsum(many) - many)[some]
                rows[some], letters[some] = np.add.reduceat(scores, lead), np.add.reduceat(count, lead)
            self.rows, self.letters = np.concatenate([self.rows, rows]), np.concatenate([self.letters, letters])
        return self.rows[ids], self.letters[ids]


def label(scores, lengths, switch=SWITCH):
    """The best language of each word: the path of highest total score, less `switch` for every change.

    `scores` holds the words of documents in a row, `lengths` (all above 0) their numbers. A document keeps its best
    single language if no stretch of words gains as much as one switch elsewhere; the others are solved by `viterbi`.
    """
    first = np.cumsum(lengths) - lengths
    best = np.add.reduceat(scores, first, axis=0, dtype=np.float64).argmax(1)
    out = np.repeat(best, lengths)
    rows = np.arange(len(scores))
    rest = scores.astype(np.float64)
    kept = rest[rows, out]
    rest[rows, out] = -np.inf
    if scores.shape[1] == 1:
        return out
    gain = rest.max(1) - kept
    # rises of the running sum within a document: each document's sums lie far below those before it
    run = np.cumsum(gain)
    run -= np.repeat((run[first] - gain[first]), lengths)
    far = 2 * (float(np.abs(run).max()) + 1) * np.repeat(np.arange(len(lengths)), lengths)
    low = run - gain
    rise = run - far - np.minimum.accumulate(low - far)
    mixed = np.maximum.reduceat(rise, first) >= switch
    if mixed.any():
        words = np.repeat(mixed, lengths)
        out[words] = viterbi(scores[words], lengths[mixed], switch)
    return out


def viterbi(scores, lengths, switch):
    """`label` for any documents. Exact: words are cut into runs that are solved side by side for every state they may be
    entered in, then joined along each document.
    """
    n_lang = scores.shape[1]
    chunks = -(-lengths // _CHUNK)
    total = int(chunks.sum())
    lead = np.cumsum(chunks) - chunks
    doc = np.repeat(np.arange(len(lengths)), chunks)
    rank = np.arange(total) - lead[doc]
    word_doc = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(scores)) - (np.cumsum(lengths) - lengths)[word_doc]
    cell = lead[word_doc] * _CHUNK + place
    grid = np.zeros((total * _CHUNK, n_lang), np.float64)
    grid[cell] = scores
    grid = grid.reshape(total, _CHUNK, n_lang)

    through = np.full((total, n_lang, n_lang), -1e300)
    through[:, np.arange(n_lang), np.arange(n_lang)] = 0
    for t in range(_CHUNK):
        through = np.maximum(through, through.max(2, keepdims=True) - switch) + grid[:, t, None, :]
    by_rank = np.argsort(rank, kind="stable")
    cuts = np.searchsorted(rank[by_rank], np.arange(int(chunks.max()) + 1))
    entry, now = np.zeros((total, n_lang)), np.zeros((len(lengths), n_lang))
    for a, b in zip(cuts, cuts[1:]):
        c = by_rank[a:b]
        entry[c] = now[doc[c]]
        now[doc[c]] = (entry[c][:, :, None] + through[c]).max(1)

    value, back = entry, np.empty((total, _CHUNK, n_lang), np.int16)
    for t in range(_CHUNK):
        best = value.max(1, keepdims=True) - switch
        back[:, t] = np.where(value >= best, np.arange(n_lang), value.argmax(1)[:, None])
        value = np.maximum(value, best) + grid[:, t]
    rows = np.arange(total)[:, None]
    came = np.tile(np.arange(n_lang), (total, 1))
    for t in reversed(range(_CHUNK)):
        came = back[rows, t, came]
    end, last = np.zeros(total, np.int64), now.argmax(1)
    for a, b in zip(cuts[-2::-1], cuts[:0:-1]):
        c = by_rank[a:b]
        end[c] = last[doc[c]]
        last[doc[c]] = came[c, end[c]]
    path, state = np.empty((total, _CHUNK), np.int64), end
    for t in reversed(range(_CHUNK)):
        path[:, t] = state
        state = back[np.arange(total), t, state]
    return path.reshape(-1)[cell]


def fit(docs, text="text", lang="lang", salt=("doc_id", "text"), sample_rows=SAMPLE_ROWS, max_languages=MAX_LANGUAGES):
    """A Model learned from labelled rows: about `sample_rows` of each language, chosen by a hash of the `salt` columns.

    Rows whose language or text is null teach nothing. Of more than `max_languages` labels those with the most rows are learned (ties:
    those that sort first), so a stray label here and there costs no memory; rows of the others teach nothing. Rows alike in the salt
    columns are chosen together. The counts come from Spark: at most BUCKETS per language.
    """
    spark = docs.sparkSession
    labelled = docs.filter(F.col(lang).isNotNull())
    counted = labelled.groupBy(lang).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), lang).limit(max_languages)
    sizes = dict(table_sizes(counted, max_languages))
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros((len(SCRIPT_NAMES), 0)), np.zeros(0))
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, sample_rows / sizes[k]))])
    draw = F.pmod(F.xxhash64(F.lit("sample"), *salt), F.lit(1 << 30)) / F.lit(float(1 << 30))
    number = {k: i for i, k in enumerate(languages)}

    def make():
        width = BUCKETS + len(SCRIPT_NAMES)
        held = np.zeros((len(languages), width), np.int64)

        def each(batch):
            for t, k in zip(texts_of(batch.column(0)), batch.column(1).to_pylist()):
                words = [w for c in chunks_of(t) for w in words_of(c)]
                if words:
                    buckets, _ = trigrams(words)
                    mine = held[number[k]]
                    mine += np.bincount(buckets, minlength=width)
                    mine += np.bincount([BUCKETS + script_of(w) for w in words], minlength=width)

        def last():
            at = np.nonzero(held)
            return [pa.array(at[0].astype(np.int32)), pa.array(at[1].astype(np.int32)), pa.array(held[at])]

        return each, last

    sample = labelled.filter(draw < F.coalesce(share[F.col(lang)], F.lit(0.0))).select(text, lang)
    counts = flat_map(sample, "language int, cell int, n bigint", make).groupBy("language", "cell").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros((BUCKETS + len(SCRIPT_NAMES), len(languages)))
    table[counts["cell"], counts["language"]] = counts["n"]
    return Model(languages, table[:BUCKETS], table[BUCKETS:], np.array([sizes[k] for k in languages], float))


def identify(docs, model, keep=("doc_id",), text="text", switch=SWITCH):
    """Rows (keep..., lang_pred, score, spans), one for each document row.

    lang_pred is the language of most letters, score their share of all letters, spans (lang, start, end; code points,
    end exclusive) the stretches of one language. A null text or one without a letter is `und` with score 0 and
    no span, as is every text if nothing was learned. Equal shares go to the language that sorts first. Repeated rows are
    judged one by one; nothing but the text counts.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model.learned())

    def make():
        model = Model.of(sent.value)

        def some(chunks):
            """For each document: its chunks' labels, letters, or None without a letter."""
            lengths = np.array([len(c) for c in chunks], np.int64)
            scores, letters = model.word_scores([c for cs in chunks for c in cs])
            first = np.cumsum(lengths) - lengths
            scores[first] += model.priors  # as if the prior were part of the first word
            counts = np.add.reduceat(letters, first)
            cuts = first[1:]
            return [
                (a, b) if n else None
                for a, b, n in zip(np.split(label(scores, lengths, switch), cuts), np.split(letters, cuts), counts)
            ]

        def each(texts, _):
            preds, scores, spans = [UNKNOWN] * len(texts), [0.0] * len(texts), [[] for _ in texts]
            if model.languages:
                chunks = [chunks_of(t) or [b""] for t in texts]
                n_lang = len(model.languages)
                part = np.cumsum([len(c) for c in chunks]) * n_lang * n_lang // _CELLS
                for p in np.unique(part):
                    mine = np.flatnonzero(part == p).tolist()
                    for i, found in zip(mine, some([chunks[i] for i in mine])):
                        if found:
                            letters = np.bincount(found[0], found[1], n_lang)
                            best = int(letters.argmax())
                            preds[i], scores[i] = model.languages[best], float(letters[best] / letters.sum())
                            spans[i] = _spans(texts[i], *found, model.languages)
            return [preds, scores, spans]

        return each

    return map_texts(docs, text, keep, "lang_pred string, score double, spans array<struct<lang:string,start:bigint,end:bigint>>", make)


def _spans(text, labels, letters, languages):
    """Stretches of one label among chunks with letters; one begins at its first chunk, the first one at 0, and lasts until the next."""
    at = np.flatnonzero(letters)
    labels = labels[at]
    change = np.flatnonzero(np.diff(labels)) + 1
    starts = [0]
    if len(change):
        parts = text.translate(_CHUNK_BYTES).split(b" ")
        size = np.array([len(p) for p in parts])
        begin = (np.cumsum(size + 1) - size - 1)[size > 0]
        starts += [len(text[:int(begin[c])].decode("utf-8", "replace")) for c in at[change]]
    past = [*starts[1:], len(text.decode("utf-8", "replace"))]
    return [{"lang": languages[labels[i]], "start": a, "end": b} for i, a, b in zip([0, *change.tolist()], starts, past)]


def accept(docs, model, text="text", least=0.5):
    """The document rows with letters whose main language has at least the share `least` of them, with their columns."""
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    marked = identify(inner, model, inner.columns, f"c{names.index(text)}")
    return marked.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select(
        *[F.col(f"c{i}").alias(n) for i, n in enumerate(names)]
    )
