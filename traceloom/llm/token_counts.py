"""Token counts under a unigram vocabulary, by dynamic programming shared along a trie.

A batch's new distinct pre-tokens are inserted in a trie (kept as the sorted
list, whose common prefixes are its inner paths). A depth-first walk keeps the
forward scores of the path: those of a shared prefix are computed once, and
each terminal stores its pre-token's number of tokens.
"""

from __future__ import annotations

import math
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE_MARK = "▁"
#: Pre-tokens whose counts a Python worker keeps; beyond it the table starts anew.
KNOWN_WORDS = 1_000_000
_known: dict[tuple, dict[str, int]] = {}


def unigram_scores(model_file: str) -> dict[str, int]:
    """Integer scores of a vocabulary file's pieces: millionths of minus the logarithm of the rank plus two."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=model_file)
    plain = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    return {sp.id_to_piece(i): -round(1e6 * math.log(rank + 2)) for rank, i in enumerate(plain)}


class TrieCounter:
    """Tokens of the best segmentation: highest score, then fewest tokens.

    A character that no piece covers costs ``unknown`` and counts as its UTF-8
    bytes.
    """

    def __init__(self, scores: dict[str, int], unknown: int = -30_000_000):
        self.scores, self.unknown, self.longest = scores, unknown, max(map(len, scores), default=1)

    def count(self, words: list[str]) -> dict[str, int]:
        """Terminal counts of distinct words."""
        out, get, longest = {}, self.scores.get, self.longest
        best, fewest, path = [0], [0], ""  # forward scores, and tokens, of the path's prefixes
        for word in sorted(words):
            key = SPACE_MARK + word
            shared = len(commonprefix((path, key)))
            del best[shared + 1 :], fewest[shared + 1 :]
            for end in range(shared + 1, len(key) + 1):
                low = best[end - 1] + self.unknown, -fewest[end - 1] - len(key[end - 1].encode("utf-8", "surrogatepass"))
                for start in range(max(0, end - longest), end):
                    s = get(key[start:end])
                    if s is not None:
                        t = best[start] + s, -fewest[start] - 1
                        if t > low:
                            low = t
                best.append(low[0])
                fewest.append(-low[1])
            path = key
            out[word] = fewest[len(key)]
        return out


def token_counts(docs: DataFrame, model_file: str, known_words: int = KNOWN_WORDS) -> DataFrame:
    """(doc_id, n_words, n_tokens) of every document.

    Words are what white space parts. Null and empty texts have none. Repeated
    rows are each counted; a null doc_id is kept. No documents give no rows.
    No shuffle: each task counts its own rows. Only doc_id and text are read.
    """
    scores = docs.sparkSession.sparkContext.broadcast(unigram_scores(model_file))

    def run(batches):
        counter = TrieCounter(scores.value)
        known = _known.setdefault((model_file, len(scores.value)), {})
        for b in batches:
            ids, texts = b.column(0), b.column(1)
            for lo in range(0, b.num_rows, 512):
                split = [(t or "").split() for t in texts.slice(lo, 512).to_pylist()]
                if len(known) > known_words:
                    known.clear()
                known.update(counter.count(list({w for s in split for w in s}.difference(known))))
                get = known.__getitem__
                yield pa.RecordBatch.from_arrays([ids.slice(lo, 512), pa.array([len(s) for s in split], pa.int64()), pa.array([sum(map(get, s)) for s in split], pa.int64())], ["doc_id", "n_words", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_words long, n_tokens long")
