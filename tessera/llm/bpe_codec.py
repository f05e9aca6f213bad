"""BPE encoding and decoding as streaming transducers (operator 4).

Encoding: the merge list fixes how far right of a token boundary the input
can still change it (``sufficient_lookahead``).  The encoder keeps a window of
bytes, merges it, and emits every token that ends at least that far before
the window's end; nothing later can change those.  Its memory is one window,
however long the text or a single run of letters is.

Why the lookahead is finite: take two continuations of the same text and
apply the rules in rank order.  Left of a boundary ``p`` both agree.  A rule
``(u, v)`` moves ``p`` left by ``len(u)`` only where the token starting at
``p`` is ``v`` in one of them and ``u`` ends at ``p``.  Afterwards ``u``
starts the token at the new boundary, so the next such rule ``(u2, v2)`` has a
later rank and ``u`` on the left edge of how ``v2`` was merged.  The longest
such chain, in bytes, bounds the effect.

Decoding: ids become bytes, bytes become text in an incremental UTF-8 state
machine that carries at most an unfinished character between blocks.
"""

from __future__ import annotations

import codecs
import hashlib
import struct

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from tessera.llm import bpe_vocab
from tessera.llm.common import ship_package

MEMO_WORDS = 600_000      # words remembered per Python worker
MEMO_ENTRIES = 100_000    # other pre-tokens
SHORT = 48                # bytes merged by scanning the ranks of all pairs
MEMO_CHARS = 40
CHUNK = 1 << 18           # characters fed to the encoder at a time
WINDOW = 1 << 10          # bytes merged at a time, beside the lookahead
OUT_ROWS = 256           # rows of an output batch
DECODE_IDS = 1 << 16      # ids decoded at a time


def sufficient_lookahead(vocab: bpe_vocab.Vocabulary) -> int:
    """Bytes right of a boundary that can still change the tokens left of it.

    One pass over the rules from the last to the first.  ``reach[u]`` is the
    longest chain that may follow a rule whose left token is ``u``: rules with
    a later rank whose right token has ``u`` on its left edge, where the step
    that extends ``u`` is not earlier than the rule itself.
    """
    rules, width = vocab.rules, {i: len(b) for i, b in vocab.bytes_of.items()}
    made_at = {c: r for r, (_, _, c) in enumerate(rules)}
    for r, (a, b, _) in enumerate(rules):
        if made_at.get(a, -1) >= r or made_at.get(b, -1) >= r:
            raise ValueError(f"rule {r} uses a token that a later rule makes")
    reach: dict[int, int] = {}
    waiting: list[list[tuple[int, int]]] = [[] for _ in rules]
    longest = 0
    for r in range(len(rules) - 1, -1, -1):
        for u, chain in waiting[r]:
            reach[u] = max(reach.get(u, 0), chain)
        waiting[r] = []
        a, b, _ = rules[r]
        chain = width[a] + reach.get(a, 0)
        longest = max(longest, chain)
        reach[b] = max(reach.get(b, 0), chain)
        edge = b                      # left edge of b: its left part, and so on
        while edge in made_at:
            step = made_at[edge]
            edge = rules[step][0]
            waiting[step].append((edge, chain))
    return longest


def merge_short(vocab: bpe_vocab.Vocabulary, ids: list[int]) -> list[int]:
    """The merged ids of a short window: the pair of lowest rank, leftmost
    first, until there is none (``ids`` is changed in place)."""
    rules, none = vocab.rules, len(vocab.rules)
    rank = vocab.rank_of
    pairs = [rank(a << 32 | b, none) for a, b in zip(ids, ids[1:], strict=False)]
    while pairs and (best := min(pairs)) < none:
        at = pairs.index(best)
        ids[at:at + 2] = [rules[best][2]]
        del pairs[at]
        if at:
            pairs[at - 1] = rank(ids[at - 1] << 32 | ids[at], none)
        if at < len(pairs):
            pairs[at] = rank(ids[at] << 32 | ids[at + 1], none)
    return ids


class RunEncoder:
    """Bytes of one pre-token in, ids out once they are stable."""

    def __init__(self, vocab: bpe_vocab.Vocabulary, lookahead: int, window: int = WINDOW):
        self.vocab, self.lookahead, self.window = vocab, lookahead, window
        self.held = b""

    def _merged(self) -> list[int]:
        byte_ids = self.vocab.byte_ids
        symbols = [byte_ids[b] for b in self.held]
        if len(symbols) <= SHORT:
            return merge_short(self.vocab, symbols)
        return [s for s in self.vocab.merge_symbols(symbols)[0] if s >= 0]

    def feed(self, data: bytes) -> list[int]:
        out: list[int] = []
        for at in range(0, len(data), self.window):
            self.held += data[at:at + self.window]
            if len(self.held) < self.window + self.lookahead:
                continue
            stable, end = len(self.held) - self.lookahead, 0
            for s in self._merged():
                size = len(self.vocab.bytes_of[s])
                if end + size > stable:
                    break
                end += size
                out.append(s)
            self.held = self.held[end:]
        return out

    def finish(self) -> list[int]:
        out, self.held = (self._merged() if self.held else []), b""
        return out


class _Packed(dict):
    """Short pre-token -> its ids, packed; filled on demand, emptied when full."""

    def __init__(self, codec: "Codec"):
        super().__init__()
        self.codec = codec

    def __missing__(self, word: str) -> bytes:
        packed = self.codec.pack(word)
        if len(word) <= MEMO_CHARS:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[word] = packed
        return packed


class _PackedWords(dict):
    """A word (what stands between two spaces) -> ids of it and the space
    before it, packed; words that span lines are not remembered."""

    def __init__(self, codec: "Codec"):
        super().__init__()
        self.codec, self.find, self.pretokens = codec, codec.vocab.find, codec.memo

    def __missing__(self, word: str) -> bytes:
        pieces = self.find.findall(" " + word)
        packed = (self.codec.pack(pieces[0]) if len(pieces) == 1
                  else b"".join(map(self.pretokens.__getitem__, pieces)))
        if len(word) <= MEMO_CHARS and "\n" not in word:
            if len(self) >= MEMO_WORDS:
                self.clear()
            self[word] = packed
        return packed


class Codec:
    """Streaming encoder and decoder of one vocabulary."""

    def __init__(self, vocab: bpe_vocab.Vocabulary, chunk: int = CHUNK, window: int = WINDOW):
        self.vocab, self.chunk, self.window = vocab, chunk, window
        self.lookahead = sufficient_lookahead(vocab)
        self.memo = _Packed(self)
        self.word_memo = _PackedWords(self)
        top = max(vocab.bytes_of) + 1
        self.table = [vocab.bytes_of.get(i, b"") for i in range(top)]
        space = r"\p{White_Space}"
        kinds = (r"\p{L}", r"\p{N}", r"[^\p{White_Space}\p{L}\p{N}]")
        self.go_on = [(regex.compile(k), regex.compile(f"(?:{k})*")) for k in (*kinds, space)]

    def run_encoder(self) -> RunEncoder:
        return RunEncoder(self.vocab, self.lookahead, self.window)

    def pack(self, word: str) -> bytes:
        """Packed ids of one pre-token, through the run encoder."""
        run = self.run_encoder()
        ids = run.feed(word.encode()) + run.finish()
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str):
        """Blocks of packed ids (little-endian unsigned 32-bit) of a text."""
        for piece, special in self.vocab.segments(text):
            yield from self._encode_plain(piece)
            if special is not None:
                yield struct.pack("<I", special)

    def _encode_plain(self, text: str):
        if len(text) <= self.chunk:
            words = self.vocab.words(text)
            if words is None:
                yield b"".join(map(self.memo.__getitem__, self.vocab.find.findall(text)))
            else:
                yield b"".join(map(self.memo.__getitem__, self.vocab.find.findall(words[0])))
                yield b"".join(map(self.word_memo.__getitem__, words[1:]))
            return
        held, run, kind = "", None, None
        for at in range(0, len(text), self.chunk):
            held += text[at:at + self.chunk]
            last = at + self.chunk >= len(text)
            out, done = [], 0
            if run is not None:                      # inside a long run: go on with it
                end = self.go_on[kind][1].match(held).end()
                # white space before a word leaves its last character to that word
                stop = end if last and end == len(held) else (
                    len(held) - 3 if end == len(held) else end - (kind == 3))
                stop = max(stop, 0)
                ids = run.feed(held[:stop].encode())
                done = stop
                if end < len(held) or last:
                    ids += run.finish()
                    run = None
                out.append(struct.pack(f"<{len(ids)}I", *ids))
            if run is None:
                # a match is settled once three characters follow it ('ll, white space)
                settled = len(held) if last else len(held) - 3
                while done < len(held):
                    m = self.vocab.find.match(held, done)
                    if m.end() > settled:
                        break
                    out.append(self.memo[m.group()])
                    done = m.end()
                if not last and len(held) - done >= self.chunk // 2:
                    m = self.vocab.find.match(held, done)
                    run = self.run_encoder()
                    kind = next(k for k, (one, _) in enumerate(self.go_on)
                                if one.match(held, m.end() - 1))
                    ids = run.feed(held[done:len(held) - 3].encode())
                    out.append(struct.pack(f"<{len(ids)}I", *ids))
                    done = len(held) - 3
            held = held[done:]
            yield b"".join(out)

    def decoder(self) -> "Decoder":
        return Decoder(self.table)

    def decode(self, packed: bytes):
        """Blocks of text of packed ids; broken UTF-8 becomes U+FFFD."""
        machine = self.decoder()
        for at in range(0, len(packed), 4 * DECODE_IDS):
            yield machine.feed(packed[at:at + 4 * DECODE_IDS])
        yield machine.finish()


class Decoder:
    """Packed ids in, text out: what is carried between blocks is an
    unfinished character."""

    def __init__(self, table: list[bytes]):
        self.table = table
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4").tolist()
        return self.machine.decode(b"".join(map(self.table.__getitem__, ids)))

    def finish(self) -> str:
        return self.machine.decode(b"", True)


_CODECS: dict[int, Codec] = {}


def _codec(blob: bytes) -> Codec:
    vocab = bpe_vocab.load(blob)
    if id(vocab) not in _CODECS:
        _CODECS[id(vocab)] = Codec(vocab)
    return _CODECS[id(vocab)]


def _blob(df: DataFrame, path: str):
    ship_package(df.sparkSession)
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def _run(df: DataFrame, path: str, id_col: str, value_col: str, work, out: StructType) -> DataFrame:
    """``work(codec, value) -> tuple`` of ``out``'s columns for each row.
    Output batches are small, however large the input's are."""
    blob = _blob(df, path)

    def run(batches):
        codec = _codec(blob.value)
        for batch in batches:
            for at in range(0, batch.num_rows, OUT_ROWS):
                ids, values = batch.slice(at, OUT_ROWS).columns
                done = [work(codec, v.as_py()) for v in values]
                columns = [pa.array([d[k] for d in done],
                                    pa.binary() if f.dataType == BinaryType() else pa.string())
                           for k, f in enumerate(out)]
                yield pa.RecordBatch.from_arrays([ids, *columns],
                                                 names=[id_col, *(f.name for f in out)])

    src = df.select(F.col(id_col), F.col(value_col).alias("__value"))
    return src.mapInArrow(run, StructType([src.schema[0], *out]))


_IDS, _TEXT = StructField("ids", BinaryType()), StructField("text", StringType())


def _encoded(codec: Codec, text: str | None) -> bytes:
    return b"".join(codec.encode(text)) if text else b""


def _decoded(codec: Codec, ids: bytes | None) -> str:
    return "".join(codec.decode(ids)) if ids else ""


def encode(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """One row per input row: the id and ``ids``, the token ids as packed
    little-endian unsigned 32-bit integers (binary: four bytes an id).

    Ids equal those of the ``tokenizers`` library with
    ``add_special_tokens=False``; special strings inside a text become their
    own id.  Null or empty text: empty ids.  Null ids and repeated rows pass
    through; other columns are not read; texts are processed whole.
    """
    return _run(df, tokenizer_path, id_col, text_col,
                lambda codec, text: (_encoded(codec, text),), StructType([_IDS]))


def decode(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
           ids_col: str = "ids") -> DataFrame:
    """One row per input row: the id and ``text`` decoded from packed ids.
    Null or empty ids: empty text.  An id outside the vocabulary raises
    ``IndexError``; one without bytes adds nothing."""
    return _run(df, tokenizer_path, id_col, ids_col,
                lambda codec, ids: (_decoded(codec, ids),), StructType([_TEXT]))


def round_trip(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``encode`` and ``decode`` in one pass: the id, ``ids``, ``text``."""
    def work(codec, text):
        ids = _encoded(codec, text)
        return ids, _decoded(codec, ids)

    return _run(df, tokenizer_path, id_col, text_col, work, StructType([_IDS, _TEXT]))


def text_digests(codec: Codec, text: str | None) -> tuple[int, str, str]:
    """(number of ids, SHA-256 of the packed ids, SHA-256 of the decoded text)
    of one text: every block of ids is digested and decoded when it is made."""
    ids, decoded = hashlib.sha256(), hashlib.sha256()
    n, machine = 0, codec.decoder()
    for block in codec.encode(text) if text else ():
        for at in range(0, len(block), 4 * DECODE_IDS):
            part = block[at:at + 4 * DECODE_IDS]
            n += len(part) // 4
            ids.update(part)
            decoded.update(machine.feed(part).encode())
    decoded.update(machine.finish().encode())
    return n, ids.hexdigest(), decoded.hexdigest()


def digests(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Encode, decode, and digest both: id, ``n_tokens``, ``ids_sha256``,
    ``decoded_sha256`` (of the decoded text in UTF-8).  Neither the ids nor the
    decoded text of a document are held or handed back to Spark."""
    blob = _blob(df, tokenizer_path)

    def run(batches):
        codec = _codec(blob.value)
        for batch in batches:
            n, ids, decoded = zip(*[text_digests(codec, t.as_py()) for t in batch.column(1)],
                                  strict=True) if batch.num_rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()),
                 pa.array(decoded, pa.string())],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    src = df.select(F.col(id_col), F.col(text_col).alias("__value"))
    return src.mapInArrow(run, StructType([
        src.schema[0], StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()),
        StructField("decoded_sha256", StringType())]))
