"""Blocks of the byte-level BPE hold a number for each word, and nothing of the texts."""

import numpy as np
import pyarrow as pa

from playlens.llm import op4_byte_bpe as bpe


def test_a_block_keeps_numbers_of_words_not_words():
    texts = [" ".join("word" + "abcdefghij"[i % 10] + "klmnopqrst"[k % 7] for k in range(5000)) for i in range(40)]
    before = pa.total_allocated_bytes()
    block = bpe._Block(bpe.splitter())
    for lo in range(0, 40, 10):
        sink = pa.BufferOutputStream()
        batch = pa.record_batch({"doc_id": pa.array(range(lo, lo + 10)), "text": pa.array(texts[lo: lo + 10])})
        with pa.ipc.new_stream(sink, batch.schema) as out:
            out.write_batch(batch)
        # read as a worker reads it: the columns of a batch are parts of one buffer
        message = pa.py_buffer(sink.getvalue().to_pybytes())
        block.add(pa.ipc.open_stream(message).read_all().to_batches()[0], 1)
    assert sum(block.sizes) == 200_000
    assert pa.total_allocated_bytes() - before < 10 * 200_000     # words and their offsets: 14 bytes each
    row = block.finish(3)
    words = bpe._unpacked(row.column(4)[0]).to_pylist()
    halves = bpe._table(row.column(3)[0])
    numbers = halves.column("low").to_numpy() | halves.column("high").to_numpy().astype(np.uint32) << 16
    assert len(words) == len(set(words))
    assert "".join(words[k] for k in numbers) == "".join(texts)
    assert bpe._table(row.column(1)[0]).column("doc_id").to_pylist() == list(range(40))


def test_blocks_of_null_and_empty_texts():
    block = bpe._Block(bpe.splitter())
    block.add(pa.record_batch({"doc_id": pa.array([1, None]), "text": pa.array([None, ""], pa.string())}), 0)
    row = block.finish(0)
    assert bpe._unpacked(row.column(4)[0]).to_pylist() == []
    assert bpe._unpacked(row.column(2)[0]).to_pylist() == [0, 0]
