"""Chat formatting at token level: segments are encoded one by one, reserved ids are spliced in between.

A turn is START role SEP text END. Control strings inside roles and texts are escaped before encoding
(`<|` becomes `<\\|`, `<\\|` becomes `<\\\\|` and so on), so neither the ids nor the decoded string
hold a control mark that the template has not put there, and the escape can be undone.
"""

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The control strings, in the order of their reserved ids, and the pattern of the public vocabulary.
CONTROLS = ("<|im_start|>", "<|im_sep|>", "<|im_end|>")
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

LEARNED_ROLE = "assistant"

# A conversation of more tokens comes in several pieces, each of whole turns.
PIECE_TOKENS = 1 << 20
# Longer texts are encoded in parts of at most so many code points. They are cut before a single space between other characters, where the
# pattern splits anyway; only a text without such a place in a whole part is cut elsewhere, and its ids may differ from the whole text's.
_PART = 1 << 18


def escape(text):
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text):
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def parts_of(text, most):
    """Consecutive parts of a text of at most `most` code points, cut before single spaces if there are any."""
    start = 0
    while len(text) - start > most:
        end = start + most
        cut = text.rfind(" ", start + 1, end)
        while cut > start and (text[cut - 1].isspace() or text[cut + 1].isspace()):
            cut = text.rfind(" ", start + 1, cut)
        end = cut if cut > start else end
        yield text[start:end]
        start = end
    yield text[start:]


class Codec:
    """A byte-level BPE vocabulary file (base64 token, rank per line) with reserved ids after its own."""

    def __init__(self, path):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.coder = tiktoken.Encoding("turns", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.start, self.sep, self.end = range(max(ranks.values()) + 1, max(ranks.values()) + 4)

    def encode(self, text):
        text = escape(text)
        ids = []
        for part in parts_of(text, _PART):
            ids += self.coder.encode_ordinary(part)
        return ids

    def decode(self, ids):
        return self.coder.decode_bytes(ids).decode("utf-8", "replace")


def encode_turns(conversations, vocabulary, conv="conv_id", turn="turn", role="role", text="text"):
    """Rows (conv, turn, ids, lead): the token ids of each turn and the number of ids before its text.

    Null roles and texts are empty. `vocabulary` is the path of the vocabulary file on the executors.
    """
    source = conversations.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    kinds = source.schema.fields[:2]
    schema = T.StructType([*kinds, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("lead", T.IntegerType())])

    def run(batches):
        codec = Codec(vocabulary)
        for batch in batches:
            ids, lead = [], []
            for r, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                head = [codec.start, *codec.encode(r or ""), codec.sep]
                ids.append([*head, *codec.encode(t or ""), codec.end])
                lead.append(len(head))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(ids, pa.list_(pa.int32())), pa.array(lead, pa.int32())],
                names=["conv", "turn", "ids", "lead"],
            )

    return source.mapInArrow(run, schema)


def format_chats(conversations, vocabulary, conv="conv_id", turn="turn", role="role", text="text",
                 learned=LEARNED_ROLE, piece_tokens=PIECE_TOKENS):
    """Rows (conv, piece, input_ids, loss_mask): the conversations, their turns in order, as token ids.

    Turns are ordered by `turn` (nulls first), equal ones by their token ids; repeated rows are repeated
    turns. Rows without a conversation id form one conversation with a null id. loss_mask is 1 on
    the tokens of the texts of the `learned` role and 0 elsewhere. A conversation of more than
    `piece_tokens` tokens comes in pieces 0, 1, ... of whole turns. The encoding runs on rows wherever
    they lie; turns of one conversation then stream in order through one task, which holds one piece.
    Other columns are ignored.
    """
    turns = encode_turns(conversations, vocabulary, conv, turn, role, text)
    ordered = turns.repartition("conv").sortWithinPartitions("conv", "turn", "ids").drop("turn")
    kind = turns.schema["conv"]
    schema = T.StructType([
        kind, T.StructField("piece", T.LongType()), T.StructField("input_ids", T.ArrayType(T.IntegerType())),
        T.StructField("loss_mask", T.ArrayType(T.ByteType())),
    ])
    names = [f.name for f in schema.fields]

    def run(batches):
        codec = Codec(vocabulary)
        role_ids = codec.encode(learned)
        open_conv, piece, held, size = None, 0, [], 0

        def out():
            ids = np.concatenate([i for i, _ in held])
            lengths = np.array([len(i) for i, _ in held])
            lead = np.array([n for _, n in held])
            first = np.cumsum(lengths) - lengths  # where each turn begins
            taught = np.array([i[1:n - 1].tolist() == role_ids for i, n in held])
            mark = np.zeros(len(ids) + 1, np.int32)
            np.add.at(mark, (first + lead)[taught], 1)
            np.add.at(mark, (first + lengths - 1)[taught], -1)
            mask = np.cumsum(mark)[:-1].astype(np.int8)
            return pa.RecordBatch.from_arrays([
                pa.array([open_conv[0]], kind_type), pa.array([piece], pa.int64()), _one_list(ids.astype(np.int32)), _one_list(mask),
            ], names=names)

        for batch in batches:
            kind_type = batch.schema.field(0).type
            rows = batch.column(1)
            values, offsets = rows.flatten().to_numpy(zero_copy_only=False), np.diff(rows.offsets.to_numpy())
            at = 0
            for c, n, lead in zip(batch.column(0).to_pylist(), offsets.tolist(), batch.column(2).to_pylist()):
                if open_conv != (c,) or size + n > piece_tokens:
                    if held:
                        yield out()
                    piece = piece + 1 if open_conv == (c,) else 0
                    open_conv, held, size = (c,), [], 0
                held.append((values[at:at + n], lead))
                at, size = at + n, size + n
        if held:
            yield out()

    return ordered.mapInArrow(run, schema)


def _one_list(values):
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))


def read_back(pieces, vocabulary):
    """Rows (conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) from formatted pieces.

    turns_sha256 covers role, newline, text, newline of each turn; loss_* the unescaped text under the
    mask; formatted_chars the decoded string with its control strings.
    """
    ordered = pieces.repartition("conv").sortWithinPartitions("conv", "piece").select("conv", "input_ids", "loss_mask")
    kind = pieces.schema["conv"]
    schema = T.StructType([kind, *T.StructType.fromDDL(
        "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    ).fields])
    names = [f.name for f in schema.fields]
    marks = sum(map(len, CONTROLS))

    def run(batches):
        codec = Codec(vocabulary)
        open_conv, state = None, None

        def fresh():
            return [0, hashlib.sha256(), 0, hashlib.sha256(), 0]

        def read(ids, mask):
            starts, seps, ends = (np.flatnonzero(ids == x) for x in (codec.start, codec.sep, codec.end))
            for a, s, e in zip(starts.tolist(), seps.tolist(), ends.tolist()):
                raw_role, raw_text = codec.decode(ids[a + 1:s].tolist()), codec.decode(ids[s + 1:e].tolist())
                state[0] += 1
                state[1].update(f"{unescape(raw_role)}\n{unescape(raw_text)}\n".encode())
                state[4] += marks + len(raw_role) + len(raw_text)
            edge = np.flatnonzero(np.diff(mask, prepend=np.int8(0), append=np.int8(0)))
            for a, e in edge.reshape(-1, 2).tolist():
                taught = unescape(codec.decode(ids[a:e].tolist()))
                state[2] += len(taught)
                state[3].update(taught.encode())

        def out(kind_type):
            n, turns, chars, loss, formatted = state
            values = [open_conv[0], n, turns.hexdigest(), chars, loss.hexdigest(), formatted]
            types = [kind_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=names)

        for batch in batches:
            kind_type = batch.schema.field(0).type
            for i, c in enumerate(batch.column(0).to_pylist()):
                if open_conv != (c,):
                    if open_conv:
                        yield out(kind_type)
                    open_conv, state = (c,), fresh()
                read(batch.column(1)[i].values.to_numpy(zero_copy_only=False), batch.column(2)[i].values.to_numpy(zero_copy_only=False))
        if open_conv:
            yield out(kind_type)

    return ordered.mapInArrow(run, schema)
