"""Job parameters and the fixed values the formats are made of."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Token strings, column names and numbers that data, tokenizers
# and trainers outside this package agree on.
# ---------------------------------------------------------------------------

TASK_SPECIALS = (
    "<|task-1-indicator|>",
    "<|task-2-indicator|>",
    "<|task-2-bow|>",
    "<|task-2-eow|>",
    "<|task-3-indicator|>",
    "<|task-4_1-indicator|>",
    "<|task-4_2-indicator|>",
)

TASK_TOKENS = {
    "task_1": "<|task-1-indicator|>",
    "task_2": "<|task-2-indicator|>",
    "task_3": "<|task-3-indicator|>",
    "task_4_1": "<|task-4_1-indicator|>",
    "task_4_2": "<|task-4_2-indicator|>",
}

TASK_2_REQUIRED = ("<|task-2-bow|>", "<|task-2-eow|>")

TASK_COLUMNS = (
    "閱讀測驗(含前置文章)",
    "閱讀測驗(不含前置文章)",
    "選詞填空(含前置文章)",
    "選詞填空(不含前置文章)",
)

# (words looked for in a source column's name, token put before its chats);
# the first match wins.
COLUMN_TOKENS = (
    (("閱讀測驗", "reading"), "<|task-4_1-indicator|>"),
    (("選詞填空", "cloze"), "<|task-4_2-indicator|>"),
)

BOS, EOS, UNK, PAD = "<s>", "</s>", "<unk>", "<pad>"

MARKERS = (
    BOS,
    EOS,
    UNK,
    PAD,
    "[INST]",
    "[/INST]",
    "[SYSTEM_PROMPT]",
    "[/SYSTEM_PROMPT]",
    "[AVAILABLE_TOOLS]",
    "[/AVAILABLE_TOOLS]",
    "[TOOL_CALLS]",
    "[ARGS]",
    "[TOOL_RESULTS]",
    "[/TOOL_RESULTS]",
    "[IMG]",
    "<|system|>",
    "<|user|>",
    "<|assistant|>",
    "<|end|>",
)

SPECIALS = MARKERS + TASK_SPECIALS

IGNORE_INDEX = -100
PERCENTILES = (50, 75, 80, 85, 90, 95, 99)
CONTEXT_LENGTHS = (512, 1024, 1536, 2048, 3072, 4096, 8192)


@dataclass(frozen=True)
class TaskLimit:
    """Row targets of one task: fewer than ``min_rows`` are drawn up to it,
    more than ``max_rows`` are cut down to it; None leaves that side open."""

    min_rows: int | None = None
    max_rows: int | None = None


BALANCE_POLICY = {
    "task_1": TaskLimit(),
    "task_2": TaskLimit(max_rows=50_000),
    "task_3": TaskLimit(),
    "task_4_1": TaskLimit(min_rows=15_000),
    "task_4_2": TaskLimit(min_rows=15_000),
}


@dataclass(frozen=True)
class DataParams:
    """What to read and how long, how split and how packed the result is."""

    dataset_path: str | None = None
    dataset_name: str | None = None
    dataset_revision: str | None = None
    data_dir: str | None = None
    dataset_split: str = "train"
    text_column: str = "text"
    is_continue_pretrain: bool = False
    max_seq_length: int = 4096
    validation_split: float = 0.05
    use_packing: bool = True
    seed: int = 42
    num_shards: int = 64
    chunk_rows: int = 10_000
    batch_rows: int = 16
    pad_to_multiple_of: int = 64
    add_bos: bool = False
    model_name: str | None = None


@dataclass(frozen=True)
class SpecialTokens:
    """Sequence markers of a tokenizer; an unset pad token means EOS."""

    bos: str = BOS
    eos: str = EOS
    pad: str | None = None
    extra: tuple[str, ...] = field(default=SPECIALS)

    @property
    def pad_token(self) -> str:
        return self.eos if self.pad is None else self.pad
