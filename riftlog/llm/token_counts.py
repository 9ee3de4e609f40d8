"""Counts of unigram tokens, without the tokens: count-only Viterbi.

An Aho-Corasick automaton over the vocabulary lists every piece that ends at each
character; a dynamic program carries the best score and the number of pieces on the
way there. Ties are broken as the tokenizer breaks them: of equal scores the way whose
last piece is longest stays. A character without a piece of its own may be unknown at
the price of 10 below the lowest score, and counts one token per UTF-8 byte (the
vocabulary holds all bytes) or, without byte pieces, one token per unknown run.

A text gets the word mark in front and for every blank. No piece continues past a word
mark after other characters, so words are cut apart before the program runs, and counts
of words seen before are remembered (a bounded number of them). Each text is one pass
in one task, without a shuffle.

No unigram vocabulary is at hand, and tokenizers are never trained: pieces and scores
come from a public piece model (a parameter). Scores are whole numbers, so sums are
exact whatever the cuts.

Defined results: null and empty texts have 0 tokens; repeated rows are counted each."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from riftlog.llm.text import carried

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBERED, LONGEST_REMEMBERED = 200_000, 48


def read_vocabulary(path: str = MODEL) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model, in the order of their ids."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter:
    """Counts pieces of texts. Holds the automaton of one vocabulary."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        self.single, self.automaton = set(), ahocorasick.Automaton()
        cuts = True
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
                if len(piece) == 1:
                    self.single.add(piece)
                cuts = cuts and MARK not in piece.lstrip(MARK)
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        self.bytes = {f"<0x{b:02X}>" for b in range(256)} <= {p for p, _ in vocabulary}
        outside = "\n" if cuts and not any("\n" in p and len(p) > 1 for p, _ in vocabulary) else ""
        words = f"{MARK}+[^{MARK}{outside}]*|[^{MARK}{outside}]+" + (f"|{outside}+" if outside else "")
        # Unknown runs may only be cut where they count by bytes.
        self.words = re.compile(words if cuts and self.bytes else "(?s:.+)").findall
        self.seen: dict[str, int] = {}

    def viterbi(self, word: str) -> int:
        n = len(word)
        score, count = [float("-inf")] * (n + 1), [0] * (n + 1)
        unknown_end = [False] * (n + 1)
        score[0] = 0.0
        single, unknown = self.single, self.unknown
        done = 0

        def close(upto: int) -> None:
            """Allow unknown characters that end up to ``upto``."""
            nonlocal done
            while done < upto:
                char = word[done]
                if char not in single and score[done] + unknown > score[done + 1]:
                    score[done + 1] = score[done] + unknown
                    if self.bytes:
                        count[done + 1] = count[done] + len(char.encode("utf-8", "surrogatepass"))
                    else:
                        count[done + 1] = count[done] + (not unknown_end[done])
                    unknown_end[done + 1] = True
                done += 1

        for last, (length, value) in self.automaton.iter(word):  # longest first at each end
            end = last + 1
            close(last)
            new = score[end - length] + value
            if new > score[end]:
                score[end], count[end] = new, count[end - length] + 1
        close(n)
        return count[n]

    def count(self, text: str) -> int:
        total, seen = 0, self.seen
        for word in self.words((MARK + text).replace(" ", MARK)) if text else ():
            n = seen.get(word)
            if n is None:
                n = self.viterbi(word)
                if len(word) <= LONGEST_REMEMBERED:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen[word] = n
            total += n
        return total


def count_tokens(docs: DataFrame, vocabulary: list[tuple[str, float]], *, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` (the columns ``keep``, all by default), ``n_chars`` and ``n_tokens``."""
    payload, texts_of = carried(docs, text_col, keep)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # as large as the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for batch in batches:
            texts = texts_of(batch).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array([len(t or "") for t in texts], pa.int64()), pa.array([counter.count(t or "") for t in texts], pa.int64())],
                names=["row", "n_chars", "n_tokens"],
            )

    added = T.StructType.fromDDL("n_chars long, n_tokens long")
    return payload.mapInArrow(run, T.StructType(payload.select("row").schema.fields + added.fields))
