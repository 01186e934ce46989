import subprocess
import sys

import numpy as np
import pandas as pd
import public_tokenizers

from kestrel.llm import sentencepiece_viterbi as s

CODE = """
import psutil, numpy as np
from kestrel.llm import text
size = lambda: psutil.Process().memory_info().rss / 1e6
last = []
def build():
    held = [np.ones(8000) for _ in range(3000)]  # 192 MB in pieces, with something kept behind them
    last.append(np.ones(8000))
    return held
before = size()
text.keep("an operator", "a fit", build)
full = size()
text.forget()
print(full - before, size() - before)
"""


def test_memory_of_an_earlier_operator_goes_back_to_the_system():
    full, left = map(float, subprocess.run([sys.executable, "-c", CODE], capture_output=True, text=True, check=True).stdout.split())
    assert full > 180 and left < 40


def test_encoded_frames_are_small():
    enc = s.Encoder(public_tokenizers.path("piece_bpe_32k.model"))
    texts = pd.Series([f"text number {i}" if i % 7 else None for i in range(2 * s.PIECE + 1)])
    frames = list(s.encoded(iter([texts, texts[:0], texts[:3]]), enc))
    assert [len(f) for f in frames] == [s.PIECE, s.PIECE, 1, 3]
    want = enc.encode([t or "" for t in texts])
    got = [x for f in frames[:3] for x in f["ids"]]
    assert [np.asarray(x, dtype="<u4").tobytes() for x in got] == want
    assert [n for f in frames[:3] for n in f["n_tokens"]] == [len(x) // 4 for x in want]


INDEX = """
import resource, psutil, numpy as np
from kestrel.llm import text, toxicity as t
r = np.random.default_rng(1)
p = 1 / np.arange(1, 150_001)
words = [np.unique(r.choice(150_000, 400, p=p / p.sum())).astype(np.uint64) for _ in range(8000)]
e = t.Examples(list(range(8000)), [i % 2 for i in range(8000)], words, [np.ones(len(w), np.int32) for w in words])
del words
text.forget()
class Shared:
    value = e
size = lambda: psutil.Process().memory_info().rss / 1e6
before, most = size(), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1e3
s = t._searcher("a fit", Shared)
i = s.index
print(sum(x.nbytes for x in (i.dense, i.rough, i.weight, i.at)) / 1e6, size() - before, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1e3 - before, most - before)
"""


def test_building_the_index_takes_little_beside_it():
    held, after, peak, earlier = map(float, subprocess.run([sys.executable, "-c", INDEX], capture_output=True, text=True, check=True).stdout.split())
    assert after < held + 45
    assert peak < max(earlier, held + 95)
