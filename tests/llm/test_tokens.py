"""Token files, piece encoding and token counts against the libraries on whole texts."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from tokenizers import Tokenizer, models

from quarry.llm import piece_bpe, token_files, wordpiece_counts
from tests.llm.conftest import ODD

BYTES, PIECES, WORDS = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model", "word_bpe_49k.json"))


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(BYTES)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def expected_tokens(rows, library):
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library(text or "") + [0]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files_match_the_library(spark, docs_of, small_docs, library, tmp_dir):
    rows = [r for r in small_docs if r[0] > 20] + [r for r in ODD if r[0] is not None]
    path = f"{tmp_dir}/tokens"
    token_files.write_tokens(docs_of(rows, parts=7), path, BYTES)
    got = sorted(tuple(r) for r in token_files.digest(spark, path).collect())
    assert got == sorted(expected_tokens(rows, library))


def test_null_ids_come_first_and_all_rows_stay(spark, docs_of, library, tmp_dir):
    path = f"{tmp_dir}/tokens"
    token_files.write_tokens(docs_of(ODD), path, BYTES)
    got = token_files.digest(spark, path).collect()
    assert len(got) == len(ODD)
    spans = sorted((r.start, r.n_tokens) for r in got)
    assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
    assert {r.start for r in got if r.doc_id is None} < {a for a, _ in spans[:2]} | {a for a, _ in spans}
    assert max(r.start for r in got if r.doc_id is None) < min(r.start for r in got if r.doc_id is not None)


def test_token_files_layout_and_selective_reads(spark, docs_of, small_docs, library, tmp_dir):
    path = f"{tmp_dir}/tokens"
    token_files.write_tokens(docs_of(small_docs), path, BYTES)
    import glob
    meta = pq.ParquetFile(sorted(glob.glob(f"{path}/*.parquet"))[0]).metadata.row_group(0)
    columns = {meta.column(i).path_in_schema: meta.column(i) for i in range(meta.num_columns)}
    assert "RLE_DICTIONARY" in columns["ids.list.element"].encodings
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    assert all(c.has_column_index and c.has_offset_index for c in columns.values())
    lo, hi = small_docs[10][0], small_docs[19][0]
    got = {r.doc_id: r.ids for r in token_files.read_tokens(spark, path, lo, hi).collect()}
    assert got == {i: library(t) + [0] for i, t in small_docs if lo <= i <= hi}
    plan = token_files.read_metadata(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema")[1].split(">")[0]
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThanOrEqual" in \
        token_files.read_tokens(spark, path, lo, hi)._jdf.queryExecution().executedPlan().toString()


def test_empty_table(spark, docs_of, tmp_dir):
    none = docs_of([(1, "x")]).filter("doc_id > 5")
    token_files.write_tokens(none, f"{tmp_dir}/t", BYTES)
    assert token_files.digest(spark, f"{tmp_dir}/t").collect() == []
    assert piece_bpe.encode_documents(none, PIECES).collect() == []
    assert wordpiece_counts.count_documents(none, WORDS).collect() == []


def test_pieces_match_the_library(docs_of, small_docs):
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)

    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()

    rows = small_docs + ODD
    want = []
    for i, t in rows:
        ids = lib.encode(t or "") + [lib.eos_id()]
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(lib.decode(ids))))
    got = [tuple(r) for r in piece_bpe.encode_documents(docs_of(rows), PIECES).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_piece_ids_and_carried_columns(docs_of, small_docs):
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = small_docs[:50] + ODD
    plain = piece_bpe.encode_documents(docs_of(rows), PIECES, carry=("source",))
    full = piece_bpe.encode_documents(docs_of(rows), PIECES, carry=("source",), with_ids=True)
    assert full.columns == plain.columns + ["ids"]
    assert sorted((str(tuple(r)[:-1]) for r in full.collect())) == sorted(str(tuple(r)) for r in plain.collect())
    want = sorted(((i, lib.encode(t or "") + [lib.eos_id()]) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.ids) for r in full.collect()), key=str) == want


def test_agenda_equals_the_library_on_hard_segments():
    model = piece_bpe.PieceModel(open(PIECES, "rb").read())
    for s in ["▁", "▁▁▁▁▁▁a", "▁aaaaaaaaaaaaaaaaaaaa", "▁...!!!...", "▁🙂🙂é", "▁1234567890" * 3, "▁ininining", "\n", "Next"]:
        model.check([s.replace("▁", " ")], [np.array(model.piece_ids(model.merge(s)), "<i4").tobytes()])
        assert model.merge(s) == model.merge_long(s)
    with pytest.raises(ValueError):
        model.check([" hello"], [b"1234"])


def test_pieces_do_not_depend_on_what_a_worker_met_before(spark, docs_of):
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    model = piece_bpe.PieceModel(open(PIECES, "rb").read())
    # runs of spaces are known words once a line feed follows; then marks stand behind them
    for texts in [["a \nb"], ["c . d"], ["a  \nb   \n "]] + [[f"x{' ' * n}{m} y"] for n in range(1, 6) for m in ".!?,;:"]:
        assert [x.tolist() for x in model.encode(texts)] == lib.encode(texts)
    rng = np.random.default_rng(8)
    letters = list("abcdeE .,!?;:\n\t -'0123▁é日🙂\r\x00") + [" "] * 6 + ["the", "ing", " th", "\n\n", "  ", "...", " ."]
    for _ in range(300):
        texts = ["".join(rng.choice(letters, rng.integers(0, 40))) for _ in range(100)]
        assert [x.tolist() for x in model.encode(texts)] == lib.encode(texts)
    rows = [(i, t) for i, t in enumerate(["a \nb", "c . d", " \n", "e ! f", "g  \n", "h  , i"] * 4)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)
    try:
        got = {r.doc_id: r.n_tokens for r in piece_bpe.encode_documents(docs_of(rows, parts=1), PIECES).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {i: len(lib.encode(t)) + 1 for i, t in rows}


def greedy(word, vocabulary):
    symbols, n = tuple(wordpiece_counts.word_symbols(word)), 0
    while symbols:
        k = next((k for k in range(len(symbols), 0, -1) if symbols[:k] in vocabulary), 0)
        if not k:
            return 0
        symbols, n = symbols[k:], n + 1
    return n


def test_automaton_counts_equal_greedy_matching():
    rng = np.random.default_rng(3)
    for trial in range(60):
        alphabet = [97, 98, 99]
        words = {tuple(rng.choice(alphabet, rng.integers(1, 6)).tolist()) for _ in range(8)}
        words |= {(*w[:-1], w[-1] + 256) for w in list(words)[:4]}
        if trial % 2:
            words |= {(a + k,) for a in alphabet for k in (0, 256)}
        auto = wordpiece_counts.Automaton(sorted(words))
        for _ in range(60):
            w = "".join(map(chr, rng.choice(alphabet, rng.integers(1, 12))))
            assert auto.count(wordpiece_counts.word_symbols(w)) == greedy(w, words), (w, words)


def file_words():
    """Words by the vocabulary file's own normaliser and splitter."""
    t = Tokenizer.from_file(WORDS)

    def split(text):
        text = t.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in t.pre_tokenizer.pre_tokenize_str(text)]
    return split


def test_words_equal_the_files_splitter():
    split, counter = file_words(), wordpiece_counts.Counter(open(WORDS, "rb").read())
    rng = np.random.default_rng(6)
    letters = list("ab1²½Ⅷ①x_-'., \t\n\x1c\x85\xa0ΣΑİßé日_'s٣€🙂\u200b\u2028\x00") + ["'s", "'ll", "e\u0301", "½cup", "x²y", "ⅷx"]
    texts = ["x²y ½cup ⅷx", "ΟΔΟΣ ΣΑΣ"] + ["".join(rng.choice(letters, rng.integers(0, 14))) for _ in range(3000)]
    for t, (n, *_) in zip(texts, counter(texts)):
        assert n == len(split(t)), t


def test_counts_equal_the_word_piece_model(docs_of, small_docs):
    symbols = wordpiece_counts.vocabulary_symbols(open(WORDS, "rb").read())
    spell = {"".join(chr(0xE000 + s) for s in w): i + 1 for i, w in enumerate(symbols)}
    model = Tokenizer(models.WordPiece({"[UNK]": 0} | spell, unk_token="[UNK]", continuing_subword_prefix="", max_input_chars_per_word=10**6))
    rows = small_docs[:60] + [r for r in ODD if r[0] != 9]
    got = {(r.doc_id, r.n_words): (r.n_tokens, r.n_unknown) for r in wordpiece_counts.count_documents(docs_of(rows), WORDS).collect()}
    split = file_words()
    for i, t in rows:
        words = split(t or "")
        n = sum(len(model.encode("".join(chr(0xE000 + s) for s in wordpiece_counts.word_symbols(w))).ids) for w in words)
        assert got[i, len(words)] == (n, 0)
