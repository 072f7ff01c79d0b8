"""Words of documents go to Python in pieces."""

import pyarrow as pa

from brightloom.operators import similarity


def test_batches_of_long_documents_are_small(spark, monkeypatch):
    """No row that goes to Python has more words than a piece; the counts are those of whole documents."""
    texts = [" ".join(f"w{(i * k) % 7}x" for k in range(n)) for i, n in enumerate((0, 1, 63, 64, 65, 128, 1000, 5))]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, tags string")
    plain = similarity._counted_rows

    def watched(batches):
        def looked():
            for batch in batches:
                if any(n > 64 for n in pa.compute.list_value_length(batch.column(1)).to_pylist()):
                    raise ValueError("a row with a whole document")
                yield batch

        return plain(looked())

    monkeypatch.setattr(similarity, "_counted_rows", watched)
    found = {(r["id"], r["term"]): r["tf"] for r in similarity.term_counts(docs, []).collect()}
    expected = {}
    for i, t in enumerate(texts):
        w = t.split()
        for term in w + [f"{a} {b}" for a, b in zip(w, w[1:])]:
            expected[i, term] = expected.get((i, term), 0) + 1
    assert found == expected


def test_pieces_of_a_document_are_joined_over_batches():
    schema = pa.schema([("id", pa.int64()), ("words", pa.list_(pa.string())), ("last", pa.bool_())])
    rows = [(1, ["a", "b"], False), (1, ["c"], True), (2, [], True), (3, ["a"], False), (3, ["a"], False), (3, ["d"], True), (4, ["z"], True)]
    for size in (1, 2, 3, 7):
        batches = [
            pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows[at : at + size]], schema=schema) for at in range(0, len(rows), size)
        ]
        found = [(i, w) for ids, words in similarity._whole_documents(iter(batches)) for i, w in zip(ids.to_pylist(), words.to_pylist())]
        assert found == [(1, ["a", "b", "c"]), (2, []), (3, ["a", "a", "d"]), (4, ["z"])]
