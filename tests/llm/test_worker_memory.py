"""What a Python worker keeps for as long as it lives."""

import os
import subprocess
import sys

from lorebase.llm import batches, bpe

SCRIPT = """
import os
from lorebase.llm import bpe
from lorebase.llm.queries import VOCABULARY
w = bpe.words_of(VOCABULARY)
before = len(os.listdir("/proc/self/task"))
w.encode([f" word{k}" for k in range(5000)])
print(len(os.listdir("/proc/self/task")) - before)
"""


def test_tokenizer_starts_no_threads():
    """Each of them would hold memory of its own."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "TOKENIZERS_PARALLELISM"}
    assert subprocess.run([sys.executable, "-c", SCRIPT], cwd=root, env=env, capture_output=True, text=True, check=True).stdout.strip() == "0"


def test_packed_ids():
    for ids in ([], [7], [0, 50_256, 2**31 - 1]):
        assert bpe.unpacked(bpe.packed(ids)) == ids
    assert sys.getsizeof(bpe.packed([1000, 2000, 3000])) < sys.getsizeof((1000, 2000, 3000)) + 3 * sys.getsizeof(1000)


def test_tasks_pass_on_what_they_yield():
    assert list(batches.giving_back(lambda rows: (2 * x for x in rows))([1, 2])) == [2, 4]
