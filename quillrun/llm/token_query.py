"""The query of the token files. A tokenizer's merges can't be said in SQL; a test encodes each text whole."""

from __future__ import annotations

import public_tokenizers

from quillrun.llm.registry import query, table
from quillrun.llm.token_files import checksums, read_tokens, write_token_files
from quillrun.session import fresh_dir


@query("op12_token_files")
def op12_token_files(spark, sf_dir):
    path = fresh_dir(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return checksums(read_tokens(spark, path))
