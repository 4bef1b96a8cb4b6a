"""From compiled rows to chat, training and retrieval tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from reportloom.operators.compiling import build_prompts, chat_messages
from reportloom.operators.split import train_eval_split, written


def prepare_chat(prompts: DataFrame, *, key: str, test_size: float = 0.1, seed: int = 42,
                 split_enabled: bool = True) -> DataFrame:
    """Usable prompt rows with ``messages`` and ``split``.

    Only the keys of usable rows are written to the shared folder; the split's passes read
    that table and no text. Source columns ride along, so no join back is needed.
    """
    chat = chat_messages(prompts)
    keys = written(chat.select(key), "usable-keys")
    if keys.isEmpty():
        raise ValueError("no usable prompt and answer pairs")
    return train_eval_split(chat, key=key, test_size=test_size, seed=seed, enabled=split_enabled, keys=keys)


def prepare(compiled: DataFrame, *, key: str, organs: Mapping[str, str] | DataFrame | None = None,
            columns: Mapping[str, str] | None = None, test_size: float = 0.1, seed: int = 42) -> DataFrame:
    """Compiled rows to chat rows; fails if no usable pair is left.

    The keys are written once and all shares are planned on them, so a text is read once to find the
    usable rows and once for the result.
    """
    keys = written(compiled.select(key), "compiled-keys")
    prompts = build_prompts(compiled, key=key, organs=organs, columns=columns, seed=seed, keys=keys)
    return prepare_chat(prompts, key=key, test_size=test_size, seed=seed)
