import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from logweave.llm import packing, texts, token_matrix, tokens, wordpiece

PATH = packing.default_tokenizer()
EDGE = [None, "", " ", "a", "<|endoftext|> in text", "日本語 のテキスト ☃", "x" * 5000, "Hello  world\n\n'll it's 123é", "word " * 3000, "a\x85b\xa0c", "\x00\x1c\x1d"]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(2)
    rows = [(i, t) for i, t in enumerate(EDGE)] + [(100 + i, " ".join(rng.choice(["the", "Ärger", "foo", "12", "%%%", "x-y"]) for _ in range(rng.randrange(400)))) for i in range(60)]
    rows += [(None, "no id"), (100, rows[11][1]), (100, rows[11][1])]
    return spark.createDataFrame([(d, t, 0) for d, t in rows], "doc_id long, text string, offset int").repartition(3)


def exact(text):
    from tokenizers import Tokenizer

    global _tok
    _tok = globals().get("_tok") or Tokenizer.from_file(PATH)
    return _tok.encode(text or "", add_special_tokens=False).ids


def test_same_ids_as_the_exact_library():
    enc = tokens.encoder(PATH)
    assert enc.fast is not None
    for t in EDGE + ["a" + chr(c) + " b" + chr(c) * 3 + " " + chr(c) + "\n" for c in range(0x250)]:
        assert enc.ids(t).tolist() == exact(t), repr(t)
    rng = random.Random(1)
    letters = [chr(c) for c in range(0x250)] + list("   \n\n'stre0123") * 20
    for _ in range(300):
        t = "".join(rng.choice(letters) for _ in range(60))
        assert enc.ids(t).tolist() == exact(t), repr(t)


@pytest.mark.parametrize("capacity", [1024, 64])
def test_pieces(docs, capacity):
    got = packing.pack_documents(docs, PATH, capacity=capacity, with_ids=True).toPandas()
    rows = [(r.doc_id, exact(r.text) + [0]) for r in docs.collect()]
    assert got.length.sum() == sum(len(ids) for _, ids in rows)
    # every id of every document lies in one piece: pieces of equal rows hold the same ids
    for d, ids in rows:
        mine = got[got.doc_id.isna() if d is None else got.doc_id == d]
        same = sum(1 for e, other in rows if e == d and other == ids)
        cover = np.zeros(len(ids), int)
        for p in mine.itertuples():
            part = ids[p.start: p.start + p.length]
            assert p.doc_tokens == len(ids) and list(p.ids) == part
            assert p.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
            cover[p.start: p.start + p.length] += 1
        assert (cover == same).all()
    padding = 0
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == [0, *np.cumsum(g.length)[:-1]]
        size = int(g.length.sum())
        assert size <= capacity and (g.sequence_tokens == size).all()
        padding += 0 if size & (size - 1) == 0 else capacity - size
    assert padding <= got.length.sum() / 64


def packed(lengths, capacity=1024):
    out = []
    packer = packing.Packer(capacity, out.append)
    for key, n in enumerate(lengths):
        packer.add(key, np.arange(n, dtype=np.uint32))
    packer.finish()
    return out


@pytest.mark.parametrize("kind", ["mixed", "short", "halves", "long", "few", "equal"])
def test_few_documents_are_cut(kind):
    rng = np.random.default_rng(len(kind))
    lengths = {"mixed": np.exp(rng.normal(6.3, 1.0, 8000)).astype(int) + 1, "short": rng.integers(1, 200, 8000), "halves": rng.integers(513, 700, 3000),
               "long": rng.integers(1025, 9000, 800), "few": rng.integers(1, 3000, 5), "equal": np.full(2000, 300)}[kind]
    out = packed(lengths.tolist())
    cover = {k: np.zeros(n, int) for k, n in enumerate(lengths.tolist())}
    padding = 0
    for held in out:
        size = sum(n for _, n in held)
        assert 0 < size <= 1024
        padding += 0 if size & (size - 1) == 0 else 1024 - size
        for (key, start, ids, total), n in held:
            assert len(ids) == n and ids[0] == start and total == lengths[key]
            cover[key][start: start + n] += 1
    assert all((c == 1).all() for c in cover.values())
    assert padding <= lengths.sum() / 64
    cut = sum(1 for k, n in enumerate(np.bincount([p[0][0] for held in out for p in held]).tolist()) if n > 1 and lengths[k] <= 1024)
    fit = max(1, int((lengths <= 1024).sum()))
    print(kind, "cut of those that fit:", round(cut / fit, 3), "pieces:", round(sum(len(h) for h in out) / len(lengths), 2))
    if kind in ("mixed", "short"):
        assert cut <= 0.05 * fit
    elif kind in ("halves", "equal"):
        assert cut <= 0.5 * fit


def test_matrix_round_trip(docs):
    got = token_matrix.token_matrix(docs, PATH, buffer_ids=3000).toPandas()
    assert got.sequence_id.is_unique
    found = {}
    for r in got.itertuples():
        assert len(r.input_ids) == len(r.position_ids) == 1024 and r.cu_seqlens[0] == 0
        assert list(r.input_ids[r.cu_seqlens[-1]:]) == [0] * (1024 - r.cu_seqlens[-1])
        for d, start, lo, hi in zip(r.doc_ids, r.starts, r.cu_seqlens[:-1], r.cu_seqlens[1:]):
            assert list(r.position_ids[lo:hi]) == list(range(hi - lo))
            found.setdefault(None if d is None or d != d else int(d), []).append((start, tuple(r.input_ids[lo:hi])))
    want = {}
    for r in docs.collect():
        ids = exact(r.text) + [0]
        want.setdefault(r.doc_id, []).extend((at, tuple(ids[at: at + 1024])) for at in range(0, len(ids), 1024))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}


def test_best_fit():
    rng = random.Random(3)
    for _ in range(50):
        capacity = rng.choice([8, 100, 1024])
        lengths = [rng.randrange(1, capacity + 1) for _ in range(rng.randrange(80))]
        rows = token_matrix.best_fit(lengths, capacity)
        assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
        free, plain = [], []
        for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
            fit = [f for f in free if f >= lengths[i]]
            if fit:
                free.remove(min(fit))
                free.append(min(fit) - lengths[i])
            else:
                free.append(capacity - lengths[i])
        assert sorted(capacity - sum(lengths[i] for i in r) for r in rows) == sorted(free)


def greedy(word, pieces, prefix=b" "):
    word, n = prefix + word, 0
    while word:
        for end in range(len(word), 0, -1):
            if word[:end] in pieces:
                break
        else:
            return 1
        word, n = word[end:], n + 1
    return n


def chunk_of(strings):
    return texts.raw(pa.array(strings))


def test_automaton_against_greedy():
    rng = random.Random(5)
    for spell_all in (True, False):
        for _ in range(80):
            pieces = {bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(1, 25))}
            pieces |= {b" " + p for p in rng.sample(sorted(pieces), len(pieces) // 2)}
            if spell_all:
                pieces |= {b"a", b"b", b"c", b" "}
            auto = wordpiece.Automaton(pieces)
            words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 15))) for _ in range(40)]
            data, off = chunk_of([" ".join(words)])
            starts, ends, _ = texts.words(data, off)
            assert auto.counts(data, starts, ends).tolist() == [greedy(w.encode(), pieces) for w in words]


def test_token_counts(docs):
    pieces = set(wordpiece.vocabulary(PATH))
    got = wordpiece.token_counts(docs.withColumnRenamed("offset", "N_Tokens"), PATH)
    assert got.columns == ["doc_id", "text", "n_words", "n_tokens"]
    import re
    for r in got.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        assert r.n_words == len(words)
        if len(r.text or "") < 3000:
            assert r.n_tokens == sum(greedy(w.encode(), pieces) for w in words)


def test_empty_tables(docs):
    none = docs.limit(0)
    assert packing.pack_documents(none, PATH).count() == token_matrix.token_matrix(none, PATH).count() == wordpiece.token_counts(none, PATH).count() == 0
