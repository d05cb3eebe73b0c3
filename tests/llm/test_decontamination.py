"""The texts under one index are few enough for the memory of a worker, and what is found does not depend on them."""

import pyarrow as pa

from lumetry.llm import decontamination

from .conftest import prose


def test_texts_go_under_several_indexes(monkeypatch):
    sizes = []

    class Counted(decontamination.Phrases):
        def find(self, texts):
            sizes.append(sum(map(len, texts)))
            return super().find(texts)

    phrases = Counted([("a", prose(1, 12)), ("b", prose(2, 4))], decontamination.WINDOW)
    texts = [prose(i % 5, 4000) for i in range(60)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(60)), "text": texts})
    found = [row for out in decontamination._occurrences(iter([batch]), phrases) for row in out.to_pylist()]
    assert sum(sizes) == sum(map(len, texts)) > 1 << 20 >= max(sizes)
    monkeypatch.setattr(decontamination, "SHARD_CHARS", 1 << 30)
    whole = [row for out in decontamination._occurrences(iter([batch]), phrases) for row in out.to_pylist()]
    assert found == whole and any(row["n_hit"] for row in found)
