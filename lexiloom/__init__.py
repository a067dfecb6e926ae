"""lexiloom: literary corpus analytics as Spark DataFrame transformations.

Every operator takes and returns a DataFrame and stays lazy unless its docstring
says that it writes or probes. See README.md for the map of modules.
"""

from lexiloom.operators.annotate import annotate, annotate_chunks, explode_annotations, tokenize
from lexiloom.operators.chunk import chunk_corpus, chunk_plan
from lexiloom.operators.clean import clean_corpus, corpus_statistics, strip_boilerplate
from lexiloom.operators.dialog import dialog_summary, label_dialog
from lexiloom.operators.enrich import enrich_corpus
from lexiloom.operators.lexical import pos_distribution, type_token_ratio, zipf
from lexiloom.operators.readability import chunk_stats, global_readability, sliding_readability
from lexiloom.sources.corpus import corpus_view, read_corpus
from lexiloom.sources.sinks import export_corpus, read_export, save_corpus, write_table
from lexiloom.sources.tables import read_table, read_tokens
from lexiloom.sources.validation import validate_files

__all__ = [
    "annotate",
    "annotate_chunks",
    "chunk_corpus",
    "chunk_plan",
    "chunk_stats",
    "clean_corpus",
    "corpus_statistics",
    "corpus_view",
    "dialog_summary",
    "enrich_corpus",
    "explode_annotations",
    "export_corpus",
    "global_readability",
    "label_dialog",
    "pos_distribution",
    "read_corpus",
    "read_export",
    "read_table",
    "read_tokens",
    "save_corpus",
    "sliding_readability",
    "strip_boilerplate",
    "tokenize",
    "type_token_ratio",
    "validate_files",
    "write_table",
    "zipf",
]
