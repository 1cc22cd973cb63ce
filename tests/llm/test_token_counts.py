"""Token counts against the library that the vocabulary is for."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from ledgermill.llm.token_counts import batch_counts, character_classes, count_tokens, load_merges

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["'s", "'t", "'re", "'ve", "'ll", "'", " ", "  ", "\n", "a", "B", "re", "é", "漢", "1", "²", "Ⅷ", "!", "##",
          "<|endoftext|>", "<|endof", "text|>", " ", "　", "​", "😀", "\u0085", "aaaa", "\x1c"]


def test_random_texts_agree_with_the_library():
    draw = random.Random(2)
    texts = ["".join(draw.choices(PIECES, k=draw.randint(0, 14))) for _ in range(5000)]
    library = Tokenizer.from_file(PATH)
    expected = [len(e) for e in library.encode_batch(texts, add_special_tokens=False)]
    got = batch_counts(pa.array(texts), load_merges(PATH), character_classes())
    assert np.array_equal(got, expected)


def test_odd_documents(odd_docs, odd_texts, no_docs):
    library = Tokenizer.from_file(PATH)
    rows = {r.doc_id: r for r in count_tokens(odd_docs, PATH).collect()}
    for i, text in enumerate(odd_texts):
        count = len(library.encode(text or "", add_special_tokens=False))
        assert (rows[i].n_bytes, rows[i].n_tokens) == (len((text or "").encode()), count)
        assert rows[i].over_limit == (count > 1024)
    assert count_tokens(odd_docs, PATH).count() == odd_docs.count()
    assert count_tokens(no_docs, PATH).count() == 0
