"""BPE encoding by content-defined chunks that are encoded once and joined again exactly, and decoding."""

from __future__ import annotations

import functools
import hashlib
import json
import os

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import lower_batches


#: A boundary becomes a cut if the hash of the bytes before it has these bits at zero: about every 2,000 bytes.
CUT_MASK = np.uint64(255)
#: Bytes that letters may have.
LETTER = np.array([chr(i).isalpha() if i < 128 else True for i in range(256)])
#: Bytes of chunks that a Python worker remembers.
CACHE_BYTES = 24_000_000
#: Scripts whose letters, digits and white space all Unicode versions in use agree on; other texts take the library's own way.
PLAIN = regex.compile("[^\x00-\x1b\x20-\x84\x86-ȟ̀-͎Α-ΡΣ-ώЀ-џ‐-‧€]")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Codec:
    """Encodes as the tokenizer file's own library does (no special tokens added), and decodes.

    Text is cut between letters of any script with one space between them, or behind an ideographic stop or comma, where a hash of the eight
    bytes before says so: equal passages of different texts give equal chunks, which are encoded once.  A join is accepted if the
    words around it, encoded together, have the tokens that both chunks have there; else the window is doubled, up to both
    chunks whole, and if they never agree, the whole text is encoded again.
    """

    def __init__(self, path: str):
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _letters()
        vocab = {bytes(letters[c] for c in piece): i for piece, i in spec["model"]["vocab"].items()}
        self.special = [t["content"] for t in spec["added_tokens"]]
        added = {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        size = max([*vocab.values(), *added]) + 1
        self.pieces: list[bytes] = [b""] * size
        for piece, i in [*vocab.items(), *((v, k) for k, v in added.items())]:
            self.pieces[i] = piece
        import public_tokenizers

        self.fast = tiktoken.Encoding("chunks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocab, special_tokens={}) if spec["model"]["type"] == "BPE" and spec["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} and not spec["normalizer"] else None
        self.cache: dict[str, np.ndarray] = {}
        self.held = 0
        self.reused = self.encoded = 0

    @functools.cached_property
    def library(self):
        """The file's own library, for texts that the fast way isn't sure of."""
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        out = Tokenizer.from_file(self.path)
        out.no_truncation()
        out.no_padding()
        return out

    def direct(self, text: str) -> np.ndarray:
        if self.fast is None or not text.isascii() and PLAIN.search(text) or any(s in text for s in self.special):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=())

    def cuts(self, text: str) -> tuple[bytes, np.ndarray, list[int]]:
        """The text's bytes, the places where it could be cut (at one space between letters, behind an ideographic stop), and which of them it is cut at."""
        raw = text.encode()
        if len(raw) < 256 or any(s in text for s in self.special):
            return raw, np.zeros(0, np.int64), []
        b = np.frombuffer(raw, np.uint8)
        # What is no letter among the bytes beyond ASCII is found where chunks are joined.
        at = np.flatnonzero(b[8:-1] == 32) + 8
        at = at[LETTER[b[at - 1]] & LETTER[b[at + 1]]]
        mask = CUT_MASK
        if not text.isascii() and b"\xe3\x80" in raw:
            stop = np.flatnonzero(b[5:-4] == 0xE3) + 8
            stop = stop[(b[stop - 2] == 0x80) & ((b[stop - 1] == 0x81) | (b[stop - 1] == 0x82)) & (b[stop] >= 0xC0)]
            at = np.union1d(at, stop)
            # Stops are rarer than spaces.
            mask = np.where(b[at] == 32, CUT_MASK, CUT_MASK >> np.uint64(3))
        # The eight bytes before each place as one number.
        h = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))[at - 8]
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        return raw, at, np.flatnonzero((h >> np.uint64(40)) & mask == 0).tolist()

    def chunk(self, text: str) -> np.ndarray:
        if (ids := self.cache.get(text)) is not None:
            self.reused += 1
            return ids
        ids = self.direct(text)
        self.encoded += 1
        self.held += 2 * len(text) + ids.nbytes + 200
        if self.held > CACHE_BYTES:
            self.cache.clear()
            self.held = 2 * len(text) + ids.nbytes + 200
        self.cache[text] = ids
        return ids

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        raw, at, cuts = self.cuts(text)
        if not cuts:
            return self.chunk(text)
        ends = [0, *at[cuts].tolist(), len(raw)]
        out = [self.chunk(raw[i:j].decode()) for i, j in zip(ends, ends[1:])]
        for k, cut in enumerate(cuts):
            if not self.joined(out[k], out[k + 1], raw, at, cut, ends[k], ends[k + 2]):
                return self.direct(text)
        return np.concatenate(out)

    def joined(self, left: np.ndarray, right: np.ndarray, raw: bytes, at: np.ndarray, cut: int, first: int, last: int) -> bool:
        """Whether the joined text has the ids of both chunks around their join: looked at from one place to cut to the next, then in doubled windows up to both chunks."""
        k, here = 1, int(at[cut])
        while True:
            low = max(first, int(at[cut - k])) if cut >= k else first
            high = min(last, int(at[cut + k])) if cut + k < len(at) else last
            both, size, n = self.direct(raw[low:high].decode()), here - low, 0
            while n < len(both) and size > 0:
                size -= len(self.pieces[both[n]])
                n += 1
            m = len(both) - n
            if not size and n <= len(left) and m <= len(right) and (both[:n] == left[len(left) - n :]).all() and (both[n:] == right[:m]).all():
                return True
            if (low, high) == (first, last):
                return False
            k *= 2

    def text(self, ids: np.ndarray) -> str:
        return b"".join(map(self.pieces.__getitem__, ids.tolist())).decode("utf-8", "replace")


def _letters() -> dict[str, int]:
    """The byte of each printable stand-in of byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = {chr(b): b for b in own}, 256
    for b in range(256):
        if b not in own:
            out[chr(spare)] = b
            spare += 1
    return out


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec for each file and Python worker, so that chunks stay known from batch to batch."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids (array of int).  A null text is encoded as the empty one; other columns are ignored; rows that repeat, repeat."""
    path = path or default_tokenizer()
    lower_batches(docs.sparkSession)

    def run(batches):
        c = codec(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                ids = [c.encode(t) for t in part.column(1).to_pylist()]
                flat = np.concatenate([*ids, np.zeros(0, np.uint32)]).astype(np.int32)
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text from doc_id, ids.  Null ids give a null text; ids outside the vocabulary are an error."""
    path = path or default_tokenizer()

    def run(batches):
        c = codec(path)
        for batch in batches:
            texts = [None if i is None else c.text(np.array(i, np.int64)) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids) of every whole text: encoded, decoded and digested in one pass.

    A null text is the empty one, without tokens; rows that repeat, repeat; an empty table gives an empty result; other columns are ignored.
    """
    path = path or default_tokenizer()
    lower_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        c = codec(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                ids = [c.encode(t) for t in part.column(1).to_pylist()]
                cols = [part.column(0), pa.array(list(map(len, ids)), pa.int64()), pa.array([hashlib.sha256(i.astype("<u4").tobytes()).hexdigest() for i in ids]), pa.array([hashlib.sha256(c.text(i).encode()).hexdigest() for i in ids])]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    flat = np.concatenate([*ids, np.zeros(0, np.uint32)]).astype(np.int32)
                    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                    cols, names = [*cols, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(cols, names)

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)


__all__ = ["Codec", "codec", "decode", "default_tokenizer", "encode", "round_trip"]
