"""Alignment of two tokenizers against loops over all token pairs in plain Python."""

import collections
import hashlib

import pytest

from fieldglean.llm import alignment
from fieldglean.llm.queries import QUERIES

COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def files():
    import public_tokenizers

    out = []
    for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"):
        with open(public_tokenizers.path(name), "rb") as f:
            out.append(f.read())
    return out


@pytest.fixture(scope="module")
def by_force(files):
    """Result rows of (doc_id, text): tokens from the two libraries, every overlap by comparison of ranges."""
    import sentencepiece
    import tokenizers

    a = tokenizers.Tokenizer.from_str(files[0].decode())
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_proto=files[1])
    letters = alignment.byte_alphabet()

    def spans(parts):
        at, out = 0, []
        for i, part in parts:
            out.append((i, at, at + len(part)))
            at += len(part)
        return out

    def tokens(text):
        if not text:
            return [], []
        left = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(f" {text}", add_special_tokens=False).ids]
        right = [(i, alignment.piece_bytes(b.id_to_piece(i))) for i in b.encode(text)]
        whole = f" {text}".encode()
        if any(b"".join(p for _, p in side) != whole for side in (left, right)):
            return [], []
        return spans(left), spans(right)

    def links(left, right):
        out, first = [], 0
        for i, s, e in left:
            while first < len(right) and right[first][2] <= s:
                first += 1
            k = first
            while k < len(right) and right[k][1] < e:
                out.append((i, right[k][0]))
                k += 1
        return out

    def run(rows):
        read = [tokens(t) for _, t in rows]
        linked = [links(*r) for r in read]
        counts = collections.Counter(p for ls in linked for p in set(ls))
        best = collections.Counter()
        for (i, _), n in counts.items():
            best[i] = max(best[i], n)
        out = []
        for (doc, _), (left, right), ls in zip(rows, read, linked):
            ends = sorted({e for _, _, e in left} & {e for _, _, e in right})
            groups = [",".join(str(i) for i, s, e in left if lo <= s < hi) + "|" + ",".join(str(i) for i, s, e in right if lo <= s < hi)
                      for lo, hi in zip([0, *ends], ends)] if len(left) < 3000 else grouped(left, right, ends)
            out.append((doc, len(left), len(right), len(ends), len(ls), sum(counts[p] == best[p[0]] for p in ls), sum(counts[p] for p in ls),
                        hashlib.sha256(";".join(groups).encode()).hexdigest() if ends else ""))
        return sorted(out, key=str)

    def grouped(left, right, ends):
        parts = collections.defaultdict(lambda: ([], []))
        for side, items in enumerate((left, right)):
            k = 0
            for i, s, e in items:
                while e > ends[k]:
                    k += 1
                parts[k][side].append(str(i))
        return [",".join(parts[k][0]) + "|" + ",".join(parts[k][1]) for k in range(len(ends))]

    return run


def result(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


ODD = [(1, None), (2, ""), (3, " "), (4, "  two  spaces "), (5, "▁bar"), (6, "a ▁ b"), (7, "<|endoftext|> <s> </s> <unk> <0x41>"), (8, "\t\r\n\0 x"),
       (9, "ﬁ ½ Ⅷ é é 　  ."), (10, "日本語 текст عربى 🎉🎉 👩‍👩‍👧"), (11, "x" * 3000), (12, " " * 3000), (None, "the same text"), (None, "the same text"),
       (13, "the same text"), (13, "the other text"), (14, "don't won't they'll I'm"), (15, "12345 67 8 9,000.00"), (16, "a\x1c b\x85c d")]


def test_given_table(spark, sf_dir, texts, by_force):
    assert result(QUERIES["op12_alignment"](spark, sf_dir)) == by_force(texts)


def test_odd_texts_in_small_pieces_and_chunks(spark, make_docs, texts, files, by_force):
    rows = ODD + texts[:40]
    df = make_docs([(i, t, None, None) for i, t in rows]).repartition(3)
    want = by_force(rows)
    for piece_chars, chunk_pairs in ((alignment.PIECE_CHARS, alignment.CHUNK_PAIRS), (10, 100)):
        assert result(alignment.align(df, *files, piece_chars=piece_chars, chunk_pairs=chunk_pairs)) == want


def test_outputs(spark, make_docs, files):
    got = {r["doc_id"]: r for r in alignment.align(make_docs([(1, "Hello world", None, None), (2, "", None, None)]), *files, outputs=("groups", "groups_sha256")).collect()}
    assert got[1]["groups"].count(";") == got[1]["n_groups"] - 1 and hashlib.sha256(got[1]["groups"].encode()).hexdigest() == got[1]["groups_sha256"]
    assert (got[2]["groups"], got[2]["groups_sha256"], got[2]["n_a"]) == ("", "", 0)


def test_empty(spark, make_docs, files):
    assert alignment.align(make_docs([]), *files).collect() == []


@pytest.mark.parametrize("text", [" " * 1_000_000, "x" * 1_000_000, "\n" * 1_000_000, "ab " * 1_000_000, "é" * 500_000, "▁" * 100_000])
def test_long(files, text):
    models = alignment.pair_of(*files)
    doc, = alignment.read_texts(models, [text])
    assert doc.broken == ("▁" in text)
    assert doc.broken or doc.links == doc.a + doc.b - doc.groups
