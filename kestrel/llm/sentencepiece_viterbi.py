"""SentencePiece encoding by shared-prefix Viterbi, and decoding (operator 9).

A text is marked (a leading mark, spaces to U+2581) and cut into marked words;
no piece of the vocabulary reaches over such a cut. A task sorts the distinct
new words of a batch and walks them like a depth-first traversal of their
trie: the forward scores and the open vocabulary nodes of a prefix are kept on
a stack and reused by every word that shares it. The best segmentation of a
word maximises the sum of the pieces' scores; on ties the piece with the
earlier start wins. A character without a piece costs the smallest score minus
10 and becomes its UTF-8 bytes' pieces.

Defined cases: null and empty texts have no ids and decode to an empty text;
U+2581 in a text decodes to a space (as a space was marked by it), all other
texts decode to themselves; words of any length work, as the score of a prefix
needs its open nodes only; repeated rows get equal ids; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.text import forget

MARK = "▁"
UNKNOWN_PENALTY = 10.0
_IRREGULAR = re.compile(r"  |^ |▁")
_RUNS = re.compile(r"\n|▁+[^▁\n]*|[^▁\n]+")
_END = ""  # key of a node's own piece
PIECE = 1000  # texts encoded at once


class Encoder:
    """Viterbi encoder and decoder over the vocabulary of a model file."""

    def __init__(self, model_file: str, limit: int = 600_000):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.limit = limit
        self.known: dict[str, bytes] = {"": b""}
        self.spelled: list[bytes] = []
        self.byte_id = [0] * 256
        self.root: dict = {}
        lowest = 0.0
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                b = int(piece[3:5], 16)
                self.byte_id[b] = i
                self.spelled.append(bytes([b]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.spelled.append(b"")
            else:
                if MARK in piece.lstrip(MARK) or "\n" in piece or (piece[:2] == MARK * 2 and piece.strip(MARK)):
                    raise ValueError(f"piece {piece!r} reaches over a word's end")
                self.spelled.append(piece.replace(MARK, " ").encode())
                node = self.root
                for c in piece:
                    node = node.setdefault(c, {})
                node[_END] = (sp.get_score(i), i)
                lowest = min(lowest, sp.get_score(i))
        self.unknown = lowest - UNKNOWN_PENALTY

    def segment(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """(word, ids) of sorted distinct words; ids as little-endian uint32."""
        root, unknown = self.root, self.unknown
        score, back, open_at = [0.0], [(0, 0)], [[]]  # by prefix length
        last = ""
        for word in words:
            n = len(commonprefix((last, word)))
            del score[n + 1:], back[n + 1:], open_at[n + 1:]
            for j in range(n, len(word)):
                c = word[j]
                best, arg, still, alone = -1e300, None, [], False
                nodes = open_at[j]
                nodes.append((j, root))
                for start, node in nodes:
                    child = node.get(c)
                    if child is not None:
                        still.append((start, child))
                        end = child.get(_END)
                        if end is not None:
                            alone |= start == j
                            s = score[start] + end[0]
                            if s > best:
                                best, arg = s, (start, end[1])
                nodes.pop()
                if not alone and score[j] + unknown > best:
                    best, arg = score[j] + unknown, (j, -1)
                score.append(best)
                back.append(arg)
                open_at.append(still)
            ids, j = [], len(word)
            while j:
                start, i = back[j]
                if i >= 0:
                    ids.append(i)
                else:
                    ids.extend(self.byte_id[b] for b in reversed(word[start:j].encode("utf-8", "surrogatepass")))
                j = start
            last = word
            yield word, np.array(ids[::-1], dtype="<u4").tobytes()

    @staticmethod
    def marked_words(text: str) -> list[str]:
        """The text's marked words in order; joined they are the marked text."""
        if not text:
            return []
        if _IRREGULAR.search(text):
            return _RUNS.findall(MARK + text.replace(" ", MARK))
        return (MARK + text.replace(" ", " " + MARK).replace("\n", " \n ")).split(" ")

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.marked_words(t) for t in texts]
        distinct: set[str] = set()
        for s in split:
            distinct.update(s)
        known = self.known
        new = [w for w in distinct if w not in known]
        if len(known) + len(new) > self.limit:
            known.clear()
            known[""] = b""
            new = [w for w in distinct if w]
        new.sort()
        known.update(self.segment(new))
        return [b"".join(map(known.__getitem__, s)) for s in split]

    def decode(self, ids: bytes) -> str:
        spelled = self.spelled
        text = b"".join([spelled[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]).decode("utf-8", "replace")
        return text[1:]  # the leading mark


def encoded(batches: Iterator[pd.Series], enc: Encoder) -> Iterator[pd.DataFrame]:
    """(n_tokens, ids) of the texts, in frames of at most ``PIECE`` rows: only
    the ids of one are in memory."""
    for texts in batches:
        for at in range(0, len(texts), PIECE):
            ids = [np.frombuffer(x, dtype="<i4") for x in enc.encode([t or "" for t in texts.iloc[at:at + PIECE]])]
            yield pd.DataFrame({"n_tokens": [len(x) for x in ids], "ids": ids})


def encode_documents(docs: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every document."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        forget()
        yield from encoded(batches, Encoder(model_file))

    v = F.pandas_udf(run, "n_tokens long, ids array<int>")(F.col("text"))
    return docs.select("doc_id", v.alias("v")).select("doc_id", "v.n_tokens", "v.ids")


def decode_documents(encoded: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = Encoder(model_file)
        for ids in batches:
            yield pd.Series([enc.decode(np.asarray(x, dtype="<u4").tobytes()) if x is not None else "" for x in ids])

    return encoded.select("doc_id", F.pandas_udf(run, "string")(F.col("ids")).alias("text"))


def round_trip(docs: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, round_trip): every text is encoded, its
    ids are decoded again and compared with it."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        enc = Encoder(model_file)
        for texts in batches:
            n, crc, same = [], [], []
            for at in range(0, len(texts), 1000):
                part = [t or "" for t in texts.iloc[at:at + 1000]]
                for t, ids in zip(part, enc.encode(part), strict=True):
                    n.append(len(ids) // 4)
                    crc.append(zlib.crc32(ids))
                    same.append(enc.decode(ids) == t)
            yield pd.DataFrame({"n_tokens": n, "ids_crc32": crc, "round_trip": same})

    v = F.pandas_udf(run, "n_tokens long, ids_crc32 long, round_trip boolean")(F.col("text"))
    return docs.select("doc_id", v.alias("v")).select("doc_id", "v.n_tokens", "v.ids_crc32", "v.round_trip")
