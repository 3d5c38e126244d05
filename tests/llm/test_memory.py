"""What the tokenizers remember has a bound in characters."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[2])

SCRIPT = """
import random, resource, sys
sys.path.insert(0, {root!r})
import public_tokenizers as P
from quadrille.llm import bpe, packing
r = random.Random(1)
letters = [chr(c) for c in range(0x4E00, 0x4E00 + 3000)]
if {name!r} == "bpe":
    tool = bpe.ByteBpe(bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), P.PATTERN)
    encode = tool.encode
else:
    tool = packing.WordTokenizer(open(P.path("word_bpe_49k.json")).read())
    encode = lambda texts: tool.encode(texts, 1)
done = 0
while done < 50_000_000:
    texts = ["".join(r.choices(letters, k=20_000)) for _ in range(50)]
    done += sum(len(t.encode()) for t in texts)
    encode(texts)
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""


@pytest.mark.parametrize("name", ["bpe", "packing"])
def test_texts_without_spaces(name):
    script = SCRIPT.format(root=ROOT, name=name)
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    assert int(done.stdout) < 1000
