"""The fast ways through plain texts give what the general ways give."""

import public_tokenizers
from tokenizers import Tokenizer

from carepanel.llm import bpe, contamination

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_latin_texts_have_the_tokens_of_the_general_pattern():
    everything = "".join(map(chr, range(256)))
    texts = [everything, " ".join(everything), "Tom's 3.5 km, 1/2 \xbd\xb2 caf\xe9's \xc9COLE \xd7 \xf7 _a_ x\xb5y 7\xaa!?", "10 € for 中文's", ""]
    for text in texts:
        assert contamination.tokens_of(text) == contamination.TOKEN.findall(text)
    assert all((c in contamination.LATIN) == (c.isalnum() and not c.isdecimal()) for c in everything)


def test_latin_texts_do_not_use_the_general_pattern(monkeypatch):
    monkeypatch.setattr(contamination, "TOKEN", None)
    assert contamination.tokens_of("Caf\xe9 9.") == ["Caf\xe9", "9", "."]


def test_plain_words_are_cut_without_the_library_and_pieces_are_merged_once(monkeypatch):
    encoder, library = bpe.Encoder(PATH), Tokenizer.from_file(PATH)
    letters = "".join(c for c in map(chr, range(33, 256)) if bpe.PLAIN.fullmatch(c))
    words = [letters, *letters, "It's", "we'LL", "Stra\xdfe,", "\xc9COLE***", "caf\xe9", "CAF\xc9", "<|endoftext|>a<b", "12\xe9x"]
    merged = []
    plain_merge = bpe.MergeTables.merge
    monkeypatch.setattr(bpe.MergeTables, "merge", lambda self, ids, lengths: merged.append(len(lengths)) or plain_merge(self, ids, lengths))
    for _ in range(2):
        ids, sizes = encoder.tokenize(words)
        expected = [library.encode(w, add_special_tokens=False).ids for w in words]
        assert (ids.tolist(), sizes.tolist()) == (sum(expected, []), [len(e) for e in expected])
    assert len(merged) == 1
    cut = []
    monkeypatch.setattr(bpe.Encoder, "_pieces", lambda self, word: cut.append(word) or [])
    encoder.tokenize(["caf\xe9", "Stra\xdfe,"])
    assert cut == []
