import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from conftest_paths import SF001
from helpers import ODD_ROWS, docs_of, long_text

from cartwheel.llm.alignment import Tokenizers, align_tokenizers, default_a, default_b
from cartwheel.llm.queries import QUERIES

COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
ROWS = ODD_ROWS + [(7, "the same text again and again", "z"), (8, "a▁b and <|endoftext|> <s> </s><unk> c", None), (9, " \x00\x01 \x00", None),
                   (10, "  two  spaces  ", None), (11, "!" * 200 + "q" * 900 + " " * 50 + "end", None), (12, "don't \xa0 stop\x1c now\n x", None),
                   (13, long_text(3, 3000), None)]


def letters():
    """The byte that each letter of the byte-level vocabulary stands for, asked of the library."""
    own = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    out = {}
    for b in range(0x80):
        out[own.pre_tokenize_str(chr(b))[0][0]] = b
    for cp in [*range(0x80, 0x800, 0x3F), 0x800, *range(0x80, 0xC0), *range(0x1000, 0xFFFF, 0x777), *range(0x10000, 0x10FFFF, 0x7777)]:
        if not 0xD800 <= cp < 0xE000:
            for letter, b in zip(own.pre_tokenize_str(chr(cp))[0][0], chr(cp).encode()):
                out[letter] = b
    return out


def brute(rows):
    a = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte_of, counts, found = letters(), Counter(), []
    for doc_id, text in rows:
        ids_a, ids_b = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        parts_a = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in ids_a]
        parts_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        whole = b" " + (text or "").encode()
        if not text or b"".join(parts_a) != whole or b"".join(parts_b) != whole:
            found.append((doc_id, None))
            continue
        groups, links, own_a, own_b, at_a, at_b, i, j = [], [], [], [], 0, 0, 0, 0
        while i < len(ids_a) or j < len(ids_b):
            if at_a <= at_b:
                own_a.append(ids_a[i])
                at_a += len(parts_a[i])
                i += 1
            else:
                own_b.append(ids_b[j])
                at_b += len(parts_b[j])
                j += 1
            if at_a == at_b:
                groups.append(",".join(map(str, own_a)) + "|" + ",".join(map(str, own_b)))
                links.append((own_a[-1], own_b[-1]))
                own_a, own_b = [], []
        counts.update(links)
        found.append((doc_id, (len(ids_a), len(ids_b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest())))
    highest = Counter()
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    return Counter((d, 0, 0, 0, 0, 0, 0, "") if x is None else
                   (d, x[0], x[1], x[2], len(x[3]), sum(counts[l] == highest[l[1]] for l in x[3]), sum(counts[l] for l in x[3]), x[4]) for d, x in found)


def rows_of(df):
    return Counter(tuple(r[c] for c in COLUMNS) for r in df.select(*COLUMNS).collect())


@pytest.mark.parametrize("frequent", [500_000, 3, 0])
def test_alignment_equals_brute_force(spark, frequent):
    got = rows_of(align_tokenizers(docs_of(spark, ROWS), frequent=frequent))
    assert got == brute([r[:2] for r in ROWS])


def test_no_rows(spark):
    assert align_tokenizers(docs_of(spark, [])).collect() == []
    assert rows_of(align_tokenizers(docs_of(spark, [(1, None, "x"), (2, "", "y")]))) == Counter([(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")])


def test_chunks_are_forgotten_and_texts_stay_whole():
    with open(default_a(), encoding="utf-8") as f, open(default_b(), "rb") as g:
        both = Tokenizers(f.read(), g.read())
    assert "".join(both.chunks(" a b  c\n d")) == " a b  c\n d" and both.chunks(" a b  c\n d") == [" a", " b  c\n d"]
    text = long_text(5, 2000)
    first = both.align([text])[0]
    both.forget()
    both.cut = False
    again = both.align([text])[0]
    assert first[:4] == again[:4] and (first[4] == again[4]).all() and (first[5] == again[5]).all()


def test_copies_of_a_hot_text_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr("cartwheel.llm.alignment.HOT_ROWS", 7)
    rows = [(i, "one text of many copies" if i % 3 else f"text {i}", None) for i in range(90)]
    assert rows_of(align_tokenizers(docs_of(spark, rows))) == brute([r[:2] for r in rows])


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    assert rows_of(QUERIES["op11_tokenizer_alignment"](spark, SF001)) == brute(rows)
