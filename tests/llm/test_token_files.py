import zlib

import numpy as np
from tokenizers import Tokenizer

from wayflux.llm.queries import op4_token_files, tokenizer_path
from wayflux.llm.token_files import Encoder, read_token_files, token_table, write_token_files


def brute(rows, end=2):
    library, at, out = Tokenizer.from_file(tokenizer_path()), 0, []
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, end]
        out.append((i, at, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_all_documents_against_the_library(spark, sf_dir, texts):
    found = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in op4_token_files(spark, sf_dir).collect())
    assert found == brute(texts)


def test_encoder_equals_the_library_on_hard_texts():
    library, encoder = Tokenizer.from_file(tokenizer_path()), Encoder(tokenizer_path())
    hard = ["", " ", "a  b", "a \n\n b\t", "it's I'LL 'tis", "x<|endoftext|>y", "\x1c\x85\xa0 ¼² ªº", "日本 　 œ", "\x00",
            "tail   ", "١٢٣", "a" * 3000, "é \U0001f600", "100% (ok) --> [x]", "\r\n\r\n  z"]
    for text, ids in zip(hard, encoder.encode(hard)):
        assert np.frombuffer(ids, encoder.kind).tolist() == library.encode(text, add_special_tokens=False).ids


def test_odd_rows_and_files(spark, odd, none, tmp_path):
    manifest = write_token_files(odd, str(tmp_path / "out"), tokenizer_path())
    rows = manifest.orderBy("base").collect()
    assert rows[0].base == 0 and all(b.base == a.base + a.n_tokens for a, b in zip(rows, rows[1:]))
    found = read_token_files(manifest).orderBy("start").collect()
    assert [r.doc_id for r in found] == [None, None, 1, 2, 3, 4, 5, 5, 6, 7, 7, 8]
    assert found[2].n_tokens == 1 and found[3].n_tokens == 1
    library = Tokenizer.from_file(tokenizer_path())
    flat = np.concatenate([np.memmap(r.path + ".bin", dtype=r.kind, mode="r") for r in rows])
    one = next(r for r in found if r.doc_id == 4)
    assert flat[one.start:one.start + one.n_tokens - 1].tolist() == library.encode("one", add_special_tokens=False).ids
    assert flat[one.start + one.n_tokens - 1] == 2
    assert token_table(none, tokenizer_path()).count() == 0
