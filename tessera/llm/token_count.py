"""Token counts by heap-and-linked-list byte-pair merging (operator 1).

A text's count is its initial byte symbols minus the merges made; token ids
are never emitted.  Texts are cut into pre-tokens first; the count of a short
pre-token is memoised per Python worker (bounded).
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tessera.llm import bpe_vocab
from tessera.llm.common import ship_package

MEMO_ENTRIES = 600_000    # pre-tokens remembered per Python worker
MEMO_CHARS = 40           # longer pre-tokens are counted anew each time
LONG_TEXT = 1 << 20       # characters; longer texts are scanned without a list


class _Counts(dict):
    """Pre-token -> token count; filled on demand, emptied when full."""

    def __init__(self, vocab):
        super().__init__()
        self.vocab = vocab

    def __missing__(self, word: str) -> int:
        byte_ids = self.vocab.byte_ids
        symbols = [byte_ids[b] for b in word.encode()]
        n = len(symbols)
        if n > 1:
            n -= self.vocab.merge_symbols(symbols)[1]
        if len(word) <= MEMO_CHARS:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[word] = n
        return n


class _WordCounts(dict):
    """A word (what stands between two spaces) -> tokens of it and the space
    before it; words that span lines are not remembered."""

    def __init__(self, vocab):
        super().__init__()
        self.vocab, self.pretokens = vocab, _Counts(vocab)

    def __missing__(self, word: str) -> int:
        n = sum(map(self.pretokens.__getitem__, self.vocab.find.findall(" " + word)))
        if len(word) <= MEMO_CHARS and "\n" not in word:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[word] = n
        return n


_MEMO: dict[int, _WordCounts] = {}


def count_text(vocab: bpe_vocab.Vocabulary, text: str) -> int:
    """Tokens of one text (added tokens inside it count one each)."""
    memo = _MEMO.get(id(vocab))
    if memo is None:
        memo = _MEMO[id(vocab)] = _WordCounts(vocab)
    pretokens = memo.pretokens
    n = 0
    for piece, special in vocab.segments(text):
        n += special is not None
        if len(piece) > LONG_TEXT:
            n += sum(pretokens[m.group()] for m in vocab.find.finditer(piece))
            continue
        words = vocab.words(piece)
        if words is None:
            n += sum(map(pretokens.__getitem__, vocab.find.findall(piece)))
        else:
            n += sum(map(pretokens.__getitem__, vocab.find.findall(words[0])))
            n += sum(map(memo.__getitem__, words[1:]))
    return n


def count_tokens(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                 text_col: str = "text", limit: int = 1024) -> DataFrame:
    """One row per input row: the id, ``n_bytes`` (UTF-8), ``n_tokens`` and
    ``over_limit`` (``n_tokens > limit``).

    Counts equal those of the ``tokenizers`` library without begin, end or
    added special tokens; special strings inside a text count as one token, as
    its default has it.  Null or empty text: 0 bytes, 0 tokens.  Null ids and
    repeated rows pass through; other columns are not read.  Texts are
    processed whole.  The tokenizer file is read on the driver and sent to the
    tasks (its size is that of one vocabulary, about 1.5 MB).
    """
    ship_package(df.sparkSession)
    with open(tokenizer_path, "rb") as f:
        blob = df.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        vocab = bpe_vocab.load(blob.value)
        for batch in batches:
            text = batch.column(1)
            n_bytes = pc.cast(pc.fill_null(pc.binary_length(text), 0), pa.int64())
            counts = [count_text(vocab, t) if t else 0 for t in (x.as_py() for x in text)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), n_bytes, pa.array(counts, pa.int64())],
                names=[id_col, "n_bytes", "n_tokens"])

    src = df.select(F.col(id_col), F.col(text_col).alias("__text"))
    schema = StructType([src.schema[0], StructField("n_bytes", LongType()),
                         StructField("n_tokens", LongType())])
    return (src.mapInArrow(run, schema)
            .withColumn("over_limit", F.col("n_tokens") > F.lit(limit)))
