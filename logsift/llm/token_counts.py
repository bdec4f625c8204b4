"""Token counts with a SentencePiece model: Arrow batches in, lengths only out.

The partitions are balanced by bytes (file splits); inside a task, texts are taken
in groups of bounded bytes.  Every text is split at safe boundaries, a space
after another character: no piece of the model has the word mark anywhere but at
its start, so no merge crosses such a boundary and the lengths add up.  A group's
distinct parts that have not been counted yet are encoded in batches of bounded
bytes; counts of parts are remembered in a table of bounded size.  A model with
pieces that do cross spaces is applied to whole texts.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from logsift.llm.common import CHUNK_BYTES, byte_groups, texts

REMEMBERED = 400_000
ENCODE_BYTES = 1 << 18


def safe_parts(text: str) -> list[str]:
    """Parts whose token counts add up to the text's.

    A part after the first stands for itself with one more space before it,
    which is what the model puts before a text of its own.
    """
    parts = text.replace("▁", " ").split(" ")  # the model reads the word mark itself as a space
    if "" not in parts:
        return parts
    out, blanks = [], 0
    for p in parts:
        if p:
            out.append(" " * (blanks - bool(out)) + p)
            blanks = 0
        blanks += 1
    blanks -= 1
    if not out:
        return [" " * blanks] if blanks else []
    out[-1] += " " * blanks
    return out


def token_counts(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit), one row per input row.

    ``model`` is the content of a SentencePiece model file.  A null text counts
    as empty (0 bytes, 0 tokens); ids may be null or repeated.
    """
    src = texts(docs, id_col, text_col)

    def run(batches):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        splits = not any("▁" in sp.id_to_piece(i).lstrip("▁") for i in range(sp.get_piece_size()))
        known: dict[str, int] = {}

        def count(batch):
            sizes = batch.column(2).to_pylist()
            column = batch.column(1)
            for group in byte_groups(iter(enumerate(sizes)), lambda x: x[1]):
                whole = [column[i].as_py() for i, _ in group]
                parts = [safe_parts(t) if splits else [t] for t in whole]
                new = [p for p in set().union(*parts) if p not in known]
                for some in byte_groups(iter(new), len, ENCODE_BYTES):
                    known.update(zip(some, map(len, sp.encode(some, num_threads=1))))
                yield from (sum(map(known.__getitem__, p)) for p in parts)
                if len(known) > REMEMBERED:
                    known.clear()

        for b in batches:
            b = b.append_column("n_bytes", pa.compute.binary_length(b.column(1)).cast(pa.int64()))
            n = pa.array(count(b), type=pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), n, pa.compute.greater(n, limit)],
                                             ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
