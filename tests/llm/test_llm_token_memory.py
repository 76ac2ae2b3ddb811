"""A worker that packs token files holds no tokenizer memory."""

from corpusprep.llm import rans_tokens as rt


def test_packing_drops_the_tokenizers(monkeypatch):
    monkeypatch.setattr(rt, "_OPEN", {"words.json": object()})
    batches = list(rt._write("unused", rt.FILE_TOKENS)(iter([])))
    assert rt._OPEN == {} and [b.num_rows for b in batches] == [0]
