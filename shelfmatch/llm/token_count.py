"""Token counts under a unigram vocabulary, without making the tokens.

An Aho-Corasick automaton enumerates every vocabulary piece that ends at a place of a word; dynamic programming carries
the best score and the number of pieces of the best path. Words are what the word-start mark separates, as in the tokenizers
library's ``Metaspace``; each distinct word of a task is segmented once.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfmatch.llm.common import by_text, doc_texts

MARK = "▁"
#: What an unknown character scores below the least piece.
UNKNOWN_PENALTY = 10.0
#: Words a task remembers, and the longest of them.
CACHED, CACHED_LENGTH = 400_000, 48


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model file, read on the driver; its size bounds what goes to the tasks."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter(dict):
    """Word (with its mark) to tokens, unknown characters and score of its best path.

    Of two paths to a place with equal score the one whose last piece starts earlier wins, an unknown character last: the
    tie rule of the tokenizers library, which goes through starts in order and replaces only by strictly better. An unknown
    character becomes its UTF-8 bytes if the vocabulary has all byte pieces, else unknown neighbours are one token.
    """

    def __init__(self, vocabulary: list[tuple[str, float]]):
        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p, _ in vocabulary if len(p) == 1}
        self.bytes = {f"<0x{i:02X}>" for i in range(256)} <= {p for p, _ in vocabulary}
        self.longest = max((len(p) for p, _ in vocabulary), default=1)
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY

    def __missing__(self, word: str) -> tuple[int, int, float]:
        found = self.best(word)
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHED:
                self.clear()
            self[word] = found
        return found

    def best(self, word: str) -> tuple[int, int, float]:
        # Only as many places are kept as the longest piece reaches back.
        n = len(word)
        size = n + 1 if n < 1024 else self.longest + 1
        score, count, unknown = [0.0] * size, [0] * size, [0] * size
        last_unknown = [False] * size
        matches = iter(self.automaton.iter(word)) if len(self.automaton) else iter(())
        at, match = next(matches, (n, None))
        for end in range(n):
            best = start = None
            while at == end:
                length, worth = match
                path = score[(end + 1 - length) % size] + worth
                if best is None or path > best:
                    best, start = path, (end + 1 - length) % size
                at, match = next(matches, (n, None))
            here, before = (end + 1) % size, end % size
            char = word[end]
            if char not in self.single and (best is None or score[before] + self.unknown > best):
                score[here], unknown[here] = score[before] + self.unknown, unknown[before] + 1
                if self.bytes:
                    count[here] = count[before] + len(char.encode("utf-8", "surrogatepass"))
                else:
                    count[here] = count[before] + (not last_unknown[before])
                last_unknown[here] = True
            else:
                score[here], count[here], unknown[here], last_unknown[here] = best, count[start] + 1, unknown[start], False
        return count[n % size], unknown[n % size], score[n % size]


def words_of(text: str) -> list[str]:
    """Words with their mark: spaces become marks, the text gets one in front unless it starts with one."""
    if not text:
        return []
    parts = text.replace(" ", MARK).split(MARK)
    return [MARK + p for p in (parts if parts[0] else parts[1:])]


def token_counts(docs: DataFrame, vocabulary: list[tuple[str, float]]) -> DataFrame:
    """``doc_id, n_tokens, n_unknown, score`` for every whole text.

    Null and empty texts have no tokens and score 0. Repeated rows stay, an empty table gives an empty result, other columns
    are not read. ``vocabulary`` goes to the tasks whole; it is a tokenizer's, tens of thousands of pieces.
    """

    def reader():
        counter = Counter(vocabulary)

        def read(texts: list[str]) -> list[pa.Array]:
            rows = []
            for text in texts:
                found = list(map(counter.__getitem__, words_of(text)))
                rows.append((sum(f[0] for f in found), sum(f[1] for f in found), sum(f[2] for f in found)))
            return [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([float(r[2]) for r in rows], pa.float64())]

        return read

    return by_text(doc_texts(docs), reader, "n_tokens long, n_unknown long, score double")
