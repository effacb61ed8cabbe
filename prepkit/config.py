"""Job settings, read from a JSON file or from command-line flags."""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from dataclasses import MISSING, dataclass, field, fields
from typing import Any, get_type_hints

MODEL_TYPES = ("causal-lm", "seq2seq")

# Other names for the same setting.
ALIASES = {
    "dataset_name_or_path": "dataset_name",
    "dataset_subset_name": "dataset_config_name",
    "preprocessing_num_workers": "processing_num_workers",
}

# Settings of a training loop and its model. They are accepted and handed on, not used here.
TRAINER_SETTINGS = frozenset(
    """
    adam_beta1 adam_beta2 adam_epsilon bf16 config_name config_name_or_path dataloader_drop_last dataloader_num_workers
    dataloader_pin_memory ddp_backend disable_tqdm eval_accumulation_steps eval_delay eval_steps
    eval_strategy evaluation_strategy fp16 generation_max_length generation_num_beams
    gradient_accumulation_steps gradient_checkpointing group_by_length label_smoothing_factor learning_rate load_best_model_at_end local_rank log_level
    logging_dir logging_first_step logging_steps logging_strategy lr_scheduler_type max_grad_norm
    max_steps metric_for_best_model greater_is_better model_name_or_path no_cuda num_train_epochs optim
    overwrite_output_dir overwrite_vocab overwrite_vocabulary override_vocabulary_embeddings predict_with_generate
    preprocessing_batch_size preprocessing_only push_to_hub remove_unused_columns report_to resume_from_checkpoint run_name
    save_steps save_strategy save_total_limit tf32 use_fast_tokenizer warmup_ratio warmup_steps weight_decay
    """.split()
)


@dataclass(frozen=True)
class Job:
    """Settings every task shares."""

    dataset_name: str | None = None
    dataset_config_name: str | None = None
    dataset_format: str = "parquet"
    dataset_schema: str | None = None
    dataset_options: dict[str, str] = field(default_factory=dict)
    key_column_name: str = "id"
    train_split_name: str = "train"
    eval_split_name: str | None = None
    max_train_samples: int | None = None
    max_eval_samples: int | None = None
    do_train: bool = True
    do_eval: bool = True
    tokenizer_name: str | None = None
    cache_dir: str | None = None
    overwrite_cache: bool = False
    output_dir: str | None = None
    processing_num_workers: int | None = None
    per_device_train_batch_size: int = 8
    per_device_eval_batch_size: int = 8
    seed: int = 42
    validation_fraction: float = 0.15
    shards: int | None = None
    rows_per_shard: int | None = 100_000
    vocab_size: int = 30_000
    label_vocab_path: str | None = None
    token_vocab_path: str | None = None
    encoder: str = "word"
    encoder_width: int | None = None
    add_special_tokens: bool | None = None
    pad_token: str | None = None
    eos_token: str | None = None
    trainer: dict[str, Any] = field(default_factory=dict, compare=False)

    def columns(self) -> list[str]:
        """Input columns the job reads."""
        return [self.key_column_name]

    def inputs(self) -> list[str]:
        """All columns to be loaded."""
        return self.columns()

    def shaping(self) -> dict[str, Any]:
        """The settings that shape the prepared tables: not where they go, nor how a model is trained on them."""
        aside = {"trainer", "output_dir", "cache_dir", "overwrite_cache", "processing_num_workers", "vector_column_name", "head_steps"}
        return {f.name: getattr(self, f.name) for f in fields(self) if f.name not in aside}

    def limits(self) -> dict[str, int | None]:
        return {"train": self.max_train_samples, "validation": self.max_eval_samples}


@dataclass(frozen=True)
class LanguageModelJob(Job):
    model_type: str = "causal-lm"
    text_column_name: str | None = None
    source_column_name: str | None = None
    target_column_name: str | None = None
    max_tokens_length: float = 512
    do_lower_case: bool = False
    eval_split_name: str | None = "validation"
    mask_padding: bool = False

    def __post_init__(self) -> None:
        require_model_type(self.model_type)

    def columns(self) -> list[str]:
        if self.model_type == "seq2seq":
            return [self.key_column_name, self.source_column_name, self.target_column_name]
        return [self.key_column_name, self.text_column_name]


@dataclass(frozen=True)
class TextClassJob(Job):
    text_column_name: str | None = None
    label_column_name: str | None = None
    max_length: int | None = None
    on_unknown_label: str = "error"
    vector_column_name: str | None = None
    head_steps: int = 100

    def columns(self) -> list[str]:
        return [self.key_column_name, self.text_column_name, self.label_column_name]

    def inputs(self) -> list[str]:
        return self.columns() + ([self.vector_column_name] if self.vector_column_name else [])


@dataclass(frozen=True)
class TokenClassJob(TextClassJob):
    max_length: int | None = 512


@dataclass(frozen=True)
class ImageClassJob(Job):
    image_column_name: str | None = None
    label_column_name: str | None = None
    requests_timeout: float = 1
    image_height: int | None = None
    image_width: int | None = None

    def columns(self) -> list[str]:
        return [self.key_column_name, self.image_column_name, self.label_column_name]


@dataclass(frozen=True)
class CaptionJob(Job):
    image_column_name: str | None = None
    text_column_name: str | None = None
    requests_timeout: float = 1
    image_height: int | None = None
    image_width: int | None = None
    max_length: int | None = None
    caption_mode: str = "repr"

    def columns(self) -> list[str]:
        return [self.key_column_name, self.image_column_name, self.text_column_name]


TASKS = {
    "language-model": LanguageModelJob,
    "text-class": TextClassJob,
    "token-class": TokenClassJob,
    "image-class": ImageClassJob,
    "caption": CaptionJob,
}


def require_model_type(model_type: str) -> None:
    if model_type not in MODEL_TYPES:
        raise ValueError(f"unsupported model_type {model_type!r}; must be one of {', '.join(MODEL_TYPES)}")


def job_from_dict(kind: type[Job], settings: dict[str, Any]) -> Job:
    """Build a job; a name that is neither a field nor a training setting is an error."""
    known = {f.name for f in fields(kind)} - {"trainer"}
    chosen: dict[str, Any] = {}
    trainer: dict[str, Any] = {}
    unknown = []
    for name, value in settings.items():
        target = ALIASES.get(name, name)
        if target in known:
            if target in chosen:
                raise ValueError(f"setting {target!r} is given twice")
            chosen[target] = value
        elif name in TRAINER_SETTINGS:
            trainer[name] = value
        else:
            unknown.append(name)
    if unknown:
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    return kind(**chosen, trainer=trainer)


def job_from_json(kind: type[Job], path: str) -> Job:
    with open(path, encoding="utf-8") as handle:
        return job_from_dict(kind, json.load(handle))


def _flag_value(hint: Any):
    text = str(hint)
    if "dict" in text:
        return json.loads
    if "bool" in text:
        return lambda v: v.lower() in ("1", "true", "yes")
    if "int" in text:
        return int
    if "float" in text:
        return float
    return str


def job_from_flags(kind: type[Job], argv: Sequence[str]) -> Job:
    parser = argparse.ArgumentParser(allow_abbrev=False)
    hints = get_type_hints(kind)
    for f in fields(kind):
        if f.name == "trainer":
            continue
        others = [f"--{alias}" for alias, name in ALIASES.items() if name == f.name]
        default = f.default if f.default is not MISSING else f.default_factory()
        parser.add_argument(
            f"--{f.name}", *others, dest=f.name, type=_flag_value(hints[f.name]), default=default
        )
    for name in sorted(TRAINER_SETTINGS):
        parser.add_argument(f"--{name}", default=None)
    given = vars(parser.parse_args(list(argv)))
    trainer = {n: given.pop(n) for n in list(given) if n in TRAINER_SETTINGS}
    return kind(**given, trainer={n: v for n, v in trainer.items() if v is not None})


def parse_job(kind: type[Job], argv: Sequence[str]) -> Job:
    """One ``.json`` argument is read as a file; anything else is read as flags."""
    if len(argv) == 1 and argv[0].endswith(".json"):
        return job_from_json(kind, argv[0])
    return job_from_flags(kind, argv)
