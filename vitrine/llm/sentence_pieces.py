"""SentencePiece models on the tokenizers library: encoding and decoding of whole texts.

The model file is parsed here and rebuilt as a tokenizers pipeline: normaliser (mark before the text, marks for
spaces), cutting before marks, merges (BPE models) or scores (unigram models), byte fallback, decoder.

Runs of two or more marks are pieces of equal score in BPE models, of which the leftmost merges first; the library
ranks them instead. Such words are merged by ``piece_model.merged``, the rest of the text by the library.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame

from vitrine.llm.core import small_batches, worker_cache
from vitrine.llm.piece_model import BPE, MARK, NORMAL, WORD, PieceModel, encode_word, normalised, parse_model

RUN = re.compile(f"{MARK}{{2,}}[^{MARK}]*")
#: Distinct words whose identifiers a worker keeps before it starts anew, and words that the library gets as one text.
KNOWN_WORDS, GROUP = 400_000, 500


class Codec:
    """Encodes and decodes batches of texts as the model does."""

    def __init__(self, model: PieceModel):
        from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

        self.model = model
        self._forget()
        vocab = {piece: i for i, piece in enumerate(model.pieces)}
        unk = model.pieces[model.unk]
        if model.kind == BPE:
            merges = []
            for piece, i in model.ids.items():
                if model.types[i] == NORMAL:
                    merges += [(-model.scores[i], i, cut, piece) for cut in range(1, len(piece))
                               if piece[:cut] in model.ids and piece[cut:] in model.ids]
            merges.sort()
            core = models.BPE(
                vocab, [(p[:cut], p[cut:]) for _, _, cut, p in merges], unk_token=unk, byte_fallback=model.byte_fallback,
                fuse_unk=False)
        else:
            core = models.Unigram(
                list(zip(model.pieces, model.scores)), unk_id=model.unk, byte_fallback=model.byte_fallback)
        self.tokenizer = Tokenizer(core)
        if model.cuttable and model.kind == BPE:
            self.tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*|[^{MARK}]+"), "removed", invert=True)
        self.tokenizer.normalizer = normalizers.Replace(" ", MARK)
        self.tokenizer.decoder = decoders.Sequence(
            [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])

    def _forget(self) -> None:
        self.known: dict[str, int] = {}  # word: its place in the arrays below
        self.tokens, self.sizes, self.good = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, bool)

    def _each(self, words: list[str]) -> tuple[list[list[int]], list[bool]]:
        """Identifiers of words one by one, and whether they decode to the word; what the library can't express is merged here."""
        plain = [w for w in words if not RUN.match(w)]
        ids = dict(zip(plain, (e.ids for e in self.tokenizer.encode_batch_fast(plain, add_special_tokens=False))))
        out = [ids[w] if w in ids else encode_word(self.model, w) for w in words]
        back = self.tokenizer.decode_batch(out, skip_special_tokens=False)
        return out, [text == w.replace(MARK, " ") for w, text in zip(words, back)]

    def _learn(self, words: list[str]) -> None:
        """Adds words to the known ones. Those with one mark in front go to the library many at a time, as one text each."""
        joined = [w for w in words if w[0] == MARK and w[1:2] not in ("", MARK)]
        groups = [joined[i:i + GROUP] for i in range(0, len(joined), GROUP)]
        texts = ["".join(g) for g in groups]
        done = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        back = self.tokenizer.decode_batch([e.ids for e in done], skip_special_tokens=False)
        tokens, sizes, good = [self.tokens], [self.sizes], [self.good]

        def add(own, ids, lengths, same):
            self.known.update(zip(own, range(len(self.known), len(self.known) + len(own))))
            tokens.append(np.asarray(ids, np.int32))
            sizes.append(np.asarray(lengths, np.int64))
            good.append(np.asarray(same, bool))

        for group, text, e, decoded in zip(groups, texts, done, back):
            same = [True] * len(group) if decoded == text.replace(MARK, " ") else self._each(group)[1]
            add(group, e.ids, np.bincount(np.asarray(e.word_ids), minlength=len(group)), same)
        others = [w for w in words if w[0] != MARK or w[1:2] in ("", MARK)]
        if others:
            ids, same = self._each(others)
            add(others, [i for x in ids for i in x], [len(x) for x in ids], same)
        self.tokens, self.sizes, self.good = np.concatenate(tokens), np.concatenate(sizes), np.concatenate(good)

    def encode_checked(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bool]]:
        """All identifiers, where those of each text end (from 0 on), and whether they decode to the text.

        Where no piece spans a cut between words, each distinct word is encoded and decoded once and remembered.
        """
        marked = [normalised(self.model, t) for t in texts]
        if self.model.kind != BPE or not self.model.cuttable:
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(marked, add_special_tokens=False)]
            ends = np.cumsum([0, *map(len, ids)])
            return (np.fromiter((i for x in ids for i in x), np.int32, int(ends[-1])), ends,
                    [a == b for a, b in zip(texts, self.decode_batch(ids))])
        split = [WORD.findall(t) for t in marked]
        distinct = dict.fromkeys(chain.from_iterable(split))
        new = [w for w in distinct if w not in self.known]
        if len(self.known) + len(new) > KNOWN_WORDS:
            self._forget()
            new = list(distinct)
        if new:
            self._learn(new)
        bounds = np.cumsum([0, *map(len, split)])
        place = np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), np.int64, int(bounds[-1]))
        sizes = self.sizes[place]
        ends = np.r_[0, np.cumsum(sizes)]
        starts = (np.cumsum(self.sizes) - self.sizes)[place]
        ids = self.tokens[np.arange(ends[-1]) + np.repeat(starts - ends[:-1], sizes)]
        bad = np.r_[0, np.cumsum(~self.good[place])]
        whole = bad[bounds[1:]] == bad[bounds[:-1]]
        first = 1 if self.model.add_prefix else 0
        same = [bool(ok) and (mark[first:] if mark else mark).replace(MARK, " ") == text for ok, mark, text in zip(whole, marked, texts)]
        return ids, ends[bounds], same

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        """Identifiers of each text, without begin and end."""
        ids, ends, _ = self.encode_checked(texts)
        return [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]

    def decode_batch(self, ids: list[list[int]]) -> list[str]:
        texts = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
        return [t[1:] if self.model.add_prefix and t.startswith(" ") else t for t in texts]


def _codec(model_bytes: bytes, threads: int) -> Codec:
    cache = worker_cache()
    if cache.get("codec_of") != model_bytes:
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        cache["codec"], cache["codec_of"] = Codec(parse_model(model_bytes)), model_bytes
    return cache["codec"]


def encode(docs: DataFrame, model_bytes: bytes, threads: int | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip) of every row; ``round_trip``: decoding gives the text back.

    Null counts as empty, an empty text has no ids, repeated rows are encoded each. Texts of any length are encoded whole; only a text that holds
    the space mark itself doesn't come back. ``threads`` of a task: spark.task.cpus unless given.
    """
    spark = docs.sparkSession
    threads = threads or int(spark.conf.get("spark.task.cpus", "1"))
    small_batches(spark)

    def encoded(batches):
        import pyarrow as pa

        codec = _codec(model_bytes, threads)
        for batch in batches:
            texts = [x or "" for x in batch.column("text").to_pylist()]
            ids, ends, same = codec.encode_checked(texts)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(ends), pa.int64()), lists, pa.array(same, pa.bool_())], ["doc_id", "n_tokens", "ids", "round_trip"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        encoded, f"doc_id {kind}, n_tokens bigint, ids array<int>, round_trip boolean")


def decode(encoded: DataFrame, model_bytes: bytes, threads: int | None = None) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give null."""
    spark = encoded.sparkSession
    threads = threads or int(spark.conf.get("spark.task.cpus", "1"))
    small_batches(spark)

    def decoded(batches):
        import pyarrow as pa

        codec = _codec(model_bytes, threads)
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            texts = codec.decode_batch([x or [] for x in ids])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([None if i is None else t for i, t in zip(ids, texts)], pa.string())],
                ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(decoded, f"doc_id {kind}, text string")
