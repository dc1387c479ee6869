import public_tokenizers
import pyarrow as pa

from tidewatch.llm import bpe, line_templates, near_duplicates, worker_tools

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_stages_without_tokenizers_drop_them():
    """A worker that goes on to another stage keeps no tables of the tokenizer of the stage before."""
    none = pa.record_batch({"text": pa.array([], pa.string())})
    stages = [
        lambda: list(near_duplicates._signed(iter([]))),
        lambda: list(near_duplicates._sets(iter([none]))),
        lambda: list(line_templates.without_lines(iter([]))),
    ]
    for run in stages:
        tools = bpe._tools(RANKS, public_tokenizers.PATTERN)
        assert bpe._tools(RANKS, public_tokenizers.PATTERN) is tools
        run()
        assert bpe._tools(RANKS, public_tokenizers.PATTERN) is not tools
    worker_tools.release()
