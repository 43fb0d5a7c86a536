"""Token counts under a unigram model, by dynamic programming shared over a trie of pre-tokens.

Pieces come from a public SentencePiece vocabulary; its order is by frequency,
so a piece of rank r scores -ln(r + OFFSET), the Zipf estimate of its log
probability. A pre-token is a white-space word behind a word mark. The best
segmentation of a word is found by forward scores over its prefixes. Distinct
words are inserted in a trie and every prefix is scored once, whatever the
number of words that share it; a word's terminal keeps its token count, and a
document's count is the sum over its words. Characters outside the vocabulary
cost one byte token for each UTF-8 byte.

Each worker keeps counts of words that it has met, up to MEMO of them or
MEMO_CHARS characters, and then starts afresh: memory is bounded by that and by
the texts that are counted together, and results are the same.

Edge cases: null, empty and white-space texts count 0; repeated rows count each;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame

from .columns import map_batches

MARK = "▁"
OFFSET = 10
#: Words that a worker remembers, and their characters.
MEMO, MEMO_CHARS = 400_000, 16_000_000
_models: dict[str, "Unigram"] = {}


class Unigram:
    """Scores of pieces, held as a trie over reversed pieces, and the memo of word counts."""

    def __init__(self, model_file: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = sp.get_piece_size()
        self.byte_score = -math.log(n + OFFSET) - 4.0
        self.backward: dict = {}
        for i in range(n):
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i):
                continue
            node = self.backward
            for c in reversed(sp.id_to_piece(i)):
                node = node.setdefault(c, {})
            node[""] = -math.log(i + OFFSET)
        self.memo: dict[str, int] = {}
        self.chars = 0

    def learn(self, words: list[str]) -> None:
        """Add words, in order, to the trie's walk and store the counts at their terminals.

        Sorted words visit the trie depth first, so the forward scores of the
        prefix shared with the word before are still in place.
        """
        scores, counts = [0.0], [0]
        before = ""
        for word in words:
            text = MARK + word
            shared = 0
            for a, b in zip(text, before):
                if a != b:
                    break
                shared += 1
            del scores[shared + 1 :], counts[shared + 1 :]
            for end in range(shared + 1, len(text) + 1):
                size = len(text[end - 1].encode("utf-8", "surrogatepass"))
                best, least = scores[end - 1] + size * self.byte_score, counts[end - 1] + size
                node, k = self.backward, end - 1
                while k >= 0:
                    node = node.get(text[k])
                    if node is None:
                        break
                    score = node.get("")
                    if score is not None:
                        total = scores[k] + score
                        if total > best or (total == best and counts[k] + 1 < least):
                            best, least = total, counts[k] + 1
                    k -= 1
                scores.append(best)
                counts.append(least)
            self.memo[word] = counts[-1]
            before = text

    def count(self, texts: list[list[str]]) -> list[int]:
        """Tokens of each list of words."""
        new = {w for words in texts for w in words if w not in self.memo}
        if len(new) + len(self.memo) > MEMO or self.chars > MEMO_CHARS:
            self.memo.clear()
            self.chars = 0
            new = {w for words in texts for w in words}
        self.chars += sum(map(len, new))
        self.learn(sorted(new))
        get = self.memo.__getitem__
        return [sum(map(get, words)) for words in texts]


def unigram(model_file: str) -> Unigram:
    if model_file not in _models:
        _models[model_file] = Unigram(model_file)
    return _models[model_file]


def count_tokens(docs: DataFrame, model_file: str) -> DataFrame:
    """One row per document: doc_id, n_words, n_tokens."""

    def run(batches):
        model = unigram(model_file)
        for batch in batches:
            rows, held, size = [], [], 0
            for text in batch["text"]:
                held.append((text or "").split())
                size += len(held[-1])
                if size >= 200_000:
                    rows += zip(map(len, held), model.count(held))
                    held, size = [], 0
            rows += zip(map(len, held), model.count(held))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_words": [r[0] for r in rows], "n_tokens": [r[1] for r in rows]})

    schema = docs.select("doc_id").schema.add("n_words", "long").add("n_tokens", "long")
    return map_batches(docs.select("doc_id", "text"), run, schema)
