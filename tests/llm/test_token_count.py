import random

import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from shelfmatch.llm.queries import vocabulary_path
from shelfmatch.llm.token_count import Counter, read_vocabulary, token_counts, words_of


def library(vocabulary, unk_id, byte_fallback):
    made = Tokenizer(models.Unigram(vocabulary, unk_id=unk_id, byte_fallback=byte_fallback))
    made.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return made


@pytest.fixture(scope="module")
def vocabulary():
    return read_vocabulary(vocabulary_path())


TEXTS = ["", " ", "  two  spaces ", "a\nb\tc", "▁mark ▁▁", "naïve Über 東京 𝔘 ✓", "<s> <0x41> </s>", "x" * 3000, "the cat sat", "\x00\x01", "a" * 1023 + "é" * 20]


def test_against_library(docs, vocabulary, awkward):
    rng = random.Random(3)
    rows = [*awkward, *[(200 + i, t) for i, t in enumerate(TEXTS)], *[(300 + i, "".join(rng.choice("abc é\n▁") for _ in range(60))) for i in range(40)]]
    reference = library(vocabulary, 0, True)
    found = sorted(((str(r.doc_id), r.n_tokens) for r in token_counts(docs(rows), vocabulary).collect()))
    assert found == sorted((str(i), len(reference.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    assert token_counts(docs([]), vocabulary).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_ties_and_unknowns(seed):
    """Small vocabularies with many equal scores: same number of tokens as the library, which shows which path won."""
    rng = random.Random(seed)
    pieces = sorted({"".join(rng.choice("▁abc") for _ in range(rng.randint(1, 3))) for _ in range(14)})
    vocabulary = [("<unk>", 0.0), *[(p, -float(rng.randint(1, 3))) for p in pieces]]
    reference, counter = library(vocabulary, 0, False), Counter(vocabulary)
    for _ in range(300):
        text = "".join(rng.choice("abcd ") for _ in range(rng.randint(0, 20)))
        found = [counter[w] for w in words_of(text)]
        assert sum(f[0] for f in found) == len(reference.encode(text, add_special_tokens=False).ids), text


def test_short_memory_of_long_words(vocabulary):
    word = "▁" + "abé" * 500
    counter = Counter(vocabulary)
    whole = counter.best(word)
    by_parts = library(vocabulary, 0, True).encode(word[1:], add_special_tokens=False)
    assert whole[0] == len(by_parts.ids)
