"""Job parameters as frozen dataclasses.

Every stage takes what it needs as arguments; these classes only carry the
defaults and read them from a nested mapping (for example a loaded YAML file).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

# Prompt texts and templates that must match the existing agent.
SYSTEM_TEMPLATE = (
    "You are an assistant that answers questions. Use the following pieces of "
    "retrieved context to answer the question. Some pieces of context may be "
    "irrelevant, in which case you should not use them to form the answer."
    "\n\nContext: {context}"
)
CHUNK_TEMPLATE = "Passage: {chunk_text}\n"
REWRITE_TEMPLATE = (
    "Based on the chat history below, we want you to generate a query for an "
    "external data source to retrieve relevant documents so that we can better "
    "answer the question. The query should be in natural language. The external "
    "data source uses similarity search to search for relevant documents in a "
    "vector space. So the query should be similar to the relevant documents "
    "semantically. Answer with only the query. Do not add explanation."
    "\n\nChat history: {chat_history}\n\nQuestion: {question}"
)


@dataclass(frozen=True)
class ChunkSettings:
    """Chunk length and overlap, in units of the length measure: characters, words, or tokens of a named tokenizer."""

    size: int = 1024
    overlap: int = 256
    measure: str = "chars"
    measure_name: str | None = None
    context_window: int | None = None

    def __post_init__(self) -> None:
        if self.size <= 0 or self.overlap < 0:
            raise ValueError("chunk size must be positive and overlap not negative")
        if self.overlap >= self.size:
            raise ValueError("chunk overlap must be smaller than chunk size")
        if self.context_window is not None and self.size + self.overlap >= self.context_window:
            raise ValueError("chunk size + overlap must stay below the model's context window")


@dataclass(frozen=True)
class IndexColumns:
    """Which index column plays which role."""

    primary_key: str = "chunk_id"
    chunk_text: str = "chunked_text"
    document_uri: str = "path"


@dataclass(frozen=True)
class RetrieverSettings:
    """Search parameters.

    ``ann`` looks into the nearest ``probes`` of 2 ** planes cells. With ``complete``
    (the default) a query whose result these cells cannot prove is searched in the
    whole index as well, so that the result is exact; without, it stays approximate.
    An index in learned cells (``CellIndex``) begins with the ``near_cells`` nearest ones instead.
    """

    k: int = 5
    query_type: str = "ann"
    planes: int = 8
    probes: int = 64
    near_cells: int = 8
    complete: bool = True
    chunk_template: str = CHUNK_TEMPLATE
    columns: IndexColumns = field(default_factory=IndexColumns)

    def __post_init__(self) -> None:
        if self.query_type not in ("ann", "exact"):
            raise ValueError(f"query_type must be 'ann' or 'exact', not {self.query_type!r}")
        if self.k < 1:
            raise ValueError("k must be at least 1")
        if not 1 <= self.planes <= 14:
            raise ValueError("planes must lie between 1 and 14")
        if not 1 <= self.probes <= 2**self.planes:
            raise ValueError("probes must lie between 1 and 2 ** planes")
        if self.near_cells < 1:
            raise ValueError("near_cells must be at least 1")


@dataclass(frozen=True)
class ChatSettings:
    system_template: str = SYSTEM_TEMPLATE
    rewrite_template: str = REWRITE_TEMPLATE
    max_tokens: int = 1500
    temperature: float = 0.01
    retriever: RetrieverSettings = field(default_factory=RetrieverSettings)


@dataclass(frozen=True)
class TableNames:
    source_path: str | None = None
    raw_files: str | None = None
    parsed_docs: str | None = None
    chunked_docs: str | None = None
    index: str | None = None
    feedback_eval_set: str | None = None
    synthetic_eval_set: str | None = None


@dataclass(frozen=True)
class Settings:
    chunk: ChunkSettings = field(default_factory=ChunkSettings)
    chat: ChatSettings = field(default_factory=ChatSettings)
    tables: TableNames = field(default_factory=TableNames)
    sync_mode: str = "TRIGGERED"

    @classmethod
    def from_mapping(cls, conf: Mapping[str, Any]) -> Settings:
        """Read the nested job mapping; unknown keys are left alone."""

        def at(*keys: str, default: Any = None) -> Any:
            node: Any = conf
            for key in keys:
                if not isinstance(node, Mapping) or key not in node:
                    return default
                node = node[key]
            return node

        chunker = ("data", "pipeline_config", "chunker", "config")
        tables = ("data", "tables_config")
        tokenizer = ("data", "embedding_config", "embedding_tokenizer")
        retriever = ("rag_chain", "retriever_config")
        llm = ("rag_chain", "llm_config")
        base = RetrieverSettings()
        return cls(
            chunk=ChunkSettings(
                size=at(*chunker, "chunk_size_tokens", default=1024),
                overlap=at(*chunker, "chunk_overlap_tokens", default=256),
                measure=at(*tokenizer, "tokenizer_source", default="chars"),
                measure_name=at(*tokenizer, "tokenizer_model_name"),
            ),
            chat=ChatSettings(
                system_template=at(*llm, "llm_system_prompt_template", default=SYSTEM_TEMPLATE),
                max_tokens=at(*llm, "llm_parameters", "max_tokens", default=1500),
                temperature=at(*llm, "llm_parameters", "temperature", default=0.01),
                retriever=RetrieverSettings(
                    k=at(*retriever, "parameters", "k", default=base.k),
                    query_type=at(*retriever, "parameters", "query_type", default=base.query_type),
                    chunk_template=at(*retriever, "chunk_template", default=CHUNK_TEMPLATE),
                    columns=IndexColumns(
                        primary_key=at(*retriever, "schema", "primary_key", default="chunk_id"),
                        chunk_text=at(*retriever, "schema", "chunk_text", default="chunked_text"),
                        document_uri=at(*retriever, "schema", "document_uri", default="path"),
                    ),
                ),
            ),
            tables=TableNames(
                source_path=at(*tables, "source_path"),
                raw_files=at(*tables, "raw_files_table_name"),
                parsed_docs=at(*tables, "parsed_docs_table_name"),
                chunked_docs=at(*tables, "chunked_docs_table_name"),
                index=at(*retriever, "vector_search_index"),
                feedback_eval_set=at(
                    "eval", "review_app_evaluation_set_fqn", default=at("eval", "evaluation_set_fqn")
                ),
                synthetic_eval_set=at("eval", "synthetic_evaluation_set_fqn"),
            ),
            sync_mode=at("vector_search", "pipeline_type", default="TRIGGERED"),
        )
