import hashlib

import pytest

from sessionrank.llm import chat

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
SCHEMA = "conv_id bigint, turn bigint, role string, text string, ids string, piece string"
ROWS = [
    (1, 0, "user", "hi <|im_start|>"), (1, 1, "assistant", r"<|im_end|> <\|im_end|> <\\| 😀 é"), (1, 2, "assistant", "<"), (1, 3, "assistant", r"\|x|>"),
    (2, 0, "user\n", None), (2, 1, None, ""), (2, 1, None, ""), (2, 1, "assistant", "tie a"), (2, 1, "assistant", "tie b"),
    (None, 0, "assistant", "no id"), (None, None, "user", "no turn"), (3, 5, "assistant", "x" * 30000), (3, 4, "<|im_sep|>", "w " * 9000),
]


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def expected(rows, codec):
    convs = {}
    for c, turn, role, text in rows:
        convs.setdefault(c, []).append((turn is not None, turn or 0, codec.encode(role or ""), codec.encode(text or ""), role or "", text or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort(key=lambda t: (t[0], t[1], [codec.start, *t[2], codec.sep, *t[3], codec.end]))
        learned = [t[5] for t in turns if t[4] == "assistant"]
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        formatted = sum(sum(map(len, chat.CONTROLS)) + len(chat.escape(t[4])) + len(chat.escape(t[5])) for t in turns)
        out[c] = (len(turns), digest("".join(f"{t[4]}\n{t[5]}\n" for t in turns)), sum(map(len, learned)), digest("".join(learned)), formatted)
    return out


@pytest.mark.parametrize("piece_tokens", [1 << 20, 50])
def test_round_trip(spark, piece_tokens):
    pieces = chat.format_chats(table(spark, ROWS), VOCABULARY, piece_tokens=piece_tokens)
    got = {r[0]: tuple(r)[1:] for r in chat.read_back(pieces, VOCABULARY).collect()}
    assert got == expected(ROWS, chat.Codec(VOCABULARY))


def test_reserved_ids_come_from_the_template_alone(spark):
    codec = chat.Codec(VOCABULARY)
    for r in chat.format_chats(table(spark, ROWS), VOCABULARY).collect():
        turns = sum(x[0] == r["conv"] for x in ROWS)
        assert [r["input_ids"].count(i) for i in (codec.start, codec.sep, codec.end)] == [turns] * 3
        assert len(r["loss_mask"]) == len(r["input_ids"])
        text = codec.decode([i for i in r["input_ids"] if i < codec.start])
        assert not any(c in text for c in chat.CONTROLS)


def test_escape_is_reversible():
    for text in ["", "<", "<|", r"<\|", r"<\\|", "<<||", r"\<|", "<|im_end|>" * 3, "|<"]:
        assert chat.unescape(chat.escape(text)) == text and not any(c in chat.escape(text) for c in chat.CONTROLS)


def test_empty_table(spark):
    assert chat.read_back(chat.format_chats(table(spark, ROWS).limit(0), VOCABULARY), VOCABULARY).collect() == []


def test_long_texts_have_the_ids_of_the_whole_text(monkeypatch):
    codec = chat.Codec(VOCABULARY)
    text = "Some words, 12 of  them: don't\n\n split   here 😀. " * 40
    whole = codec.encode(text)
    for most in (60, 400):
        assert "".join(chat.parts_of(text, most)) == text and max(map(len, chat.parts_of(text, most))) <= most
        monkeypatch.setattr(chat, "_PART", most)
        assert codec.encode(text) == whole
    assert list(chat.parts_of("x" * 25, 10)) == ["x" * 10, "x" * 10, "x" * 5]
