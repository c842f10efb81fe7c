"""Tokenizers from vocabulary files; each Python worker loads a file once."""

import base64
from functools import lru_cache

import sentencepiece
import tiktoken

from heatgrid.llm.token_alignment import Aligner, Tokenizer


@lru_cache
def byte_level(path: str, pattern: str) -> Tokenizer:
    """Byte-level BPE from a rank file; special tokens are plain text.

    The pattern must part a visible character from a space that follows it, as the usual ones do.
    """
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return Tokenizer(encoding.encode_ordinary, tokens)


@lru_cache
def pieces(path: str) -> Tokenizer:
    """A sentence-piece model with byte pieces; control pieces have no bytes."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    if any("▁" in model.id_to_piece(i).lstrip("▁") for i in range(model.get_piece_size())):
        raise ValueError(f"{path} has pieces that go on over a space")

    def bytes_of(i: int) -> bytes:
        if model.is_control(i) or model.is_unknown(i):
            return b""
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()

    tokens = [bytes_of(i) for i in range(model.get_piece_size())]
    # The model puts a space before a text by itself.
    return Tokenizer(lambda text: model.encode(text[1:], num_threads=1), tokens)


@lru_cache
def aligner(rank_path: str, pattern: str, model_path: str) -> Aligner:
    return Aligner(byte_level(rank_path, pattern), pieces(model_path))
