"""BPE encoding and decoding by forced-boundary splitting.

Bytes that never stand next to each other inside any vocabulary token cannot be merged across, so
between them a cut is certain. White space is in no token, which cuts a text into chunks before
anything else is looked at; inside a chunk the pre-tokens, and within these the byte pairs no token
holds, give fragments. Fragments are encoded independently and concatenated. As they recur, each
worker remembers a bounded number of encoded chunks.

Defined results: null and empty texts have no ids and decode to the empty text; special tokens
written in a text get their own id, as in the library; texts of any length are encoded whole.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.models import BPE
from tokenizers.pre_tokenizers import WhitespaceSplit

from ..shared_store import ship_package
from .passing import tidy
from .registry import query, read

VOCABULARY = "word_bpe_49k.json"
REMEMBERED = 300_000  # chunks, and words, a worker keeps per generation; it changes speed only
ENCODED_BYTES = 1 << 20  # of texts whose chunks are looked up together
COMPUTED = 20_000  # new chunks, or words, encoded together; it bounds memory only
LAST = "</w>"
ENDED = 0xE000  # added to the last character of a word
ENDING = set(".,;:!?")  # a pre-token each, behind letters


def byte_symbols() -> list[str]:
    """The printable symbol that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Generations(dict):
    """A bounded memory of computed values: what two generations did not ask for is forgotten."""

    def __init__(self, compute: Callable, size: int) -> None:
        super().__init__()
        self.compute, self.size, self.older = compute, size, {}

    def values_of(self, keys: list, compute: Callable[[list], list]) -> list:
        """Values of distinct keys; those not remembered are computed together."""
        values = list(map(self.get, keys))
        gone = [i for i, v in enumerate(values) if v is None]
        if gone and self.older:
            for i, value in zip(gone, map(self.older.get, [keys[i] for i in gone]), strict=True):
                values[i] = value
        new = [i for i in gone if values[i] is None]
        for at in range(0, len(new), COMPUTED):
            some = new[at : at + COMPUTED]
            for i, value in zip(some, compute([keys[i] for i in some]), strict=True):
                values[i] = value
        for at in range(0, len(gone), COMPUTED):
            some = gone[at : at + COMPUTED]
            if len(self) + len(some) > self.size:
                self.older = dict(self)
                self.clear()
            self.update(zip([keys[i] for i in some], [values[i] for i in some], strict=True))
        return values

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = value


class FragmentEncoder:
    """Encodes UTF-8 texts to ids, 4 little-endian bytes each, and ids back to text."""

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        merges = [tuple(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
        # what ends a word is one character more to the model, so that it takes fragments with and without an end
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are parallel already
        self.model = Tokenizer(BPE({ended(t): i for t, i in vocab.items()}, [(ended(a), ended(b)) for a, b in merges], cache_capacity=0))
        self.model.pre_tokenizer = WhitespaceSplit()
        self.ends_word = np.zeros(max(vocab.values()) + 1, bool)
        self.ends_word[[i for t, i in vocab.items() if ended(t) != t]] = True
        self.token_of = {i: t.encode("utf-8") for t, i in vocab.items()}
        self.token_of |= {t["id"]: t["content"].encode("utf-8") for t in spec["added_tokens"]}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.pretokens = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        symbols = byte_symbols()
        if lacking := [c for c in symbols if c not in vocab or c + LAST not in vocab]:
            raise ValueError(f"bytes without a token: {lacking}")
        self.symbols = np.array([ord(c) for c in symbols], "<u4")
        self.symbols[32] = 32
        self.certain = certain_cuts(vocab, symbols)
        self.chunks = Generations(lambda chunk: self._chunk_ids([chunk])[0], remembered)
        self.words = Generations(lambda word: self._encoded([word])[0], remembered)

    def _words_of(self, chunks: list[bytes]) -> tuple[list[str], list[int]]:
        """The words of all chunks in order, and how many each has; the blanks between chunks are in no word."""
        text = b" ".join(chunks).decode("utf-8", "replace")
        if text.isascii():
            text = text.lower()
        else:  # case is mapped character by character, without the final form of sigma
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        words, counts, pretokens = [], [], self.pretokens
        for part in text.split(" "):
            if part.isalpha() and part.isascii():  # ASCII letters are one pre-token
                words.append(part)
                counts.append(1)
            elif part[-1:] in ENDING and part[:-1].isalpha() and part.isascii():
                words += (part[:-1], part[-1])
                counts.append(2)
            else:
                own = pretokens(part)
                words += own
                counts.append(len(own))
        return words, counts

    def _encoded(self, words: list[str]) -> list[bytes]:
        """Cut words where neighbouring bytes are in no token together, encode the fragments, and join their ids.

        The last fragment carries the end of its word, which is how the model takes a whole word, and so does its last id.
        """
        codes = np.frombuffer(" ".join(words).encode("utf-8"), np.uint8)
        blank = codes == 32
        last = np.append(blank[1:], True)  # this byte ends a word
        cut = np.flatnonzero(self.certain[codes[:-1], codes[1:]] & ~blank[:-1] & ~blank[1:]) + 1
        letters = self.symbols[codes]
        letters[last] += ENDED
        text = np.insert(letters, cut, 32).tobytes().decode("utf-32-le")
        ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        return cut_up(ids.tobytes(), 4 * (np.flatnonzero(self.ends_word[ids]) + 1))

    def _chunk_ids(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of chunks, whose new words are encoded together."""
        words, counts = self._words_of(chunks)
        place = pa.array(words, pa.string()).dictionary_encode()
        values = self.words.values_of(listed(place.dictionary), self._encoded)
        held, ends = laid_out(values, place.indices)
        return cut_up(held, ends[np.cumsum(counts)])

    def many(self, texts: pa.Array) -> list[bytes]:
        """Ids of many UTF-8 texts, in ``binary``: each distinct chunk of them is looked up once, new ones together."""
        special = pc.match_substring(texts, "<|")
        plain = pc.if_else(special, pa.scalar(b"", texts.type), texts)
        parts = pc.ascii_split_whitespace(plain.view(pa.string()))
        place = parts.flatten().view(pa.binary()).dictionary_encode()
        values = self.chunks.values_of(listed(place.dictionary), self._chunk_ids)
        held, ends = laid_out(values, place.indices)
        first = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        ids = cut_up(held, ends[first[1:]])
        for i in np.flatnonzero(special.to_numpy(zero_copy_only=False)).tolist():
            ids[i] = self.ids(texts[i].as_py())
        return ids

    def ids(self, text: bytes) -> bytes:
        chunks = self.chunks
        if b"<|" not in text:
            return b"".join([chunks[c] for c in text.split()])
        found: list[bytes] = []
        for part in self.special_split.split(text.decode("utf-8", "replace")):
            if part in self.special:
                found.append(self.special[part].to_bytes(4, "little"))
            else:
                found += [chunks[c] for c in part.encode("utf-8").split()]
        return b"".join(found)

    def decode(self, ids: bytes) -> bytes:
        """The vocabulary names no decoder: tokens are written out with blanks between them."""
        return b" ".join(map(self.token_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def ended(token: str) -> str:
    """A token whose last character also says that a word ends there."""
    bare = token.removesuffix(LAST)
    return token if bare == token or not bare else bare[:-1] + chr(ord(bare[-1]) + ENDED)


def listed(values: pa.Array) -> list:
    return values.to_numpy(zero_copy_only=False).tolist()


def cut_up(held: bytes, ends: np.ndarray) -> list[bytes]:
    """Consecutive pieces by where each ends."""
    ends = ends.tolist()
    return [held[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def laid_out(values: list[bytes], indices: pa.Array) -> tuple[bytes, np.ndarray]:
    """The values at the indices one after the other, and where each begins and the last ends."""
    taken = pa.array(values, pa.large_binary()).take(indices)
    begins = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset : taken.offset + len(taken) + 1] if len(taken) else np.zeros(1, np.int64)
    data = taken.buffers()[2]
    return (data.to_pybytes()[begins[0] : begins[-1]] if data is not None else b""), begins - begins[0]


def certain_cuts(vocab: Iterable[str], symbols: list[str]) -> np.ndarray:
    """Which pairs of bytes are never neighbours inside a token: between them a cut is certain."""
    byte_of = {s: b for b, s in enumerate(symbols)}
    certain = np.ones((256, 256), bool)
    for token in vocab:
        codes = [byte_of.get(s, -1) for s in token.removesuffix(LAST)]
        if -1 not in codes:
            certain[codes[:-1], codes[1:]] = False
    return certain


_encoders: dict[tuple[str, int], FragmentEncoder] = {}


def encoder(path: str, remembered: int = REMEMBERED) -> FragmentEncoder:
    """The worker's encoder, loaded once."""
    if (path, remembered) not in _encoders:
        tidy()
        _encoders[path, remembered] = FragmentEncoder(path, remembered)
    return _encoders[path, remembered]


def forget_encoders() -> None:
    """Free the worker's encoders, for jobs whose other stages need the memory."""
    _encoders.clear()
    tidy()


def slices(batch: pa.RecordBatch, most: int = ENCODED_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows of a batch whose texts are looked up together."""
    sizes = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = sizes[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(sizes, before + most, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def vocabulary_path(name: str = VOCABULARY) -> str:
    return public_tokenizers.path(name)


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """Per row: id, ids as little-endian unsigned 32-bit bytes, decoded text."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary_path(vocabulary))
        for batch in batches:
            for part in slices(batch):
                ids = encode.many(part.column("text"))
                decoded = [encode.decode(x) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())], ["doc_id", "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids binary, decoded binary")


@query("op6_bpe")
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return encoded(docs).select(
        "doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )

