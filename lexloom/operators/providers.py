"""Remote batch providers: prompts, an interface, a bounded wait, retries, and a stub that needs no network."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import requests

#: What is asked for, and of which columns.
PROMPTS = {
    "classes": ("Give the grammatical class of the Arabic word as 'class; subclass'.", ("arabic",)),
    "weights": ("Give the pattern (wazn) of the Arabic word.", ("arabic", "root")),
    "forms": ("Give the number of the derived form of the Arabic word.", ("arabic", "root")),
    "roots": ("Give the root of the Arabic word, its letters joined by hyphens.", ("arabic",)),
    "types": ("Say whether the Arabic text is a noun, a verb or a phrase.", ("arabic",)),
    "items": ("Analyse the word of a corpus: lemma, root, pattern, part of speech, gender, number and case as JSON.", ("arabic", "sura_index", "aya_index")),
    "poem": ("Analyse the word of a poem line: lemma, root, pattern, part of speech and meaning as JSON.", ("arabic", "line")),
    "translation": ("Translate the dictionary entry; answer in JSON with english, spanish, urdu and transliteration.", ("arabic", "entry")),
}


def prompt_requests(df: DataFrame, prompt: str, ordinal: str, model: str = "stub", prompts: dict[str, tuple[str, tuple[str, ...]]] = PROMPTS) -> DataFrame:
    """(line): a request for each row; the user's text is the prompt's columns, the last ones left out where null."""
    system, columns = prompts[prompt]
    user = F.concat_ws(" | ", *[F.col(c).cast("string") for c in columns])
    return df.select(requests(F.concat(F.lit("request-"), F.col(ordinal).cast("string")), F.lit(system), user, model).alias("line"))


class Provider(Protocol):
    def create(self, lines: list[str]) -> str: ...

    def status(self, batch: str) -> str: ...

    def fetch(self, batch: str) -> list[str]: ...


class BatchFailed(RuntimeError):
    pass


def retry(call: Callable, attempts: int = 3, wait: float = 2.0, sleep: Callable[[float], None] = time.sleep):
    """The result of ``call``; tried again after a lost connection, each time after a longer wait."""
    for i in range(attempts):
        try:
            return call()
        except (ConnectionError, TimeoutError):
            if i + 1 == attempts:
                raise
            sleep(wait * 2**i)


def run_batch(provider: Provider, lines: list[str], poll: float = 60.0, most: float = 24 * 3600.0, sleep: Callable[[float], None] = time.sleep) -> list[str]:
    """The answers to ``lines``. Waits ``most`` seconds at most; a batch that ends in any other way than completed raises BatchFailed."""
    batch = retry(lambda: provider.create(lines), sleep=sleep)
    waited = 0.0
    while (state := retry(lambda: provider.status(batch), sleep=sleep)) in ("validating", "queued", "in_progress", "finalizing"):
        if waited >= most:
            raise BatchFailed(f"{batch}: still {state} after {waited:.0f} s")
        sleep(poll)
        waited += poll
    if state != "completed":
        raise BatchFailed(f"{batch}: {state}")
    return retry(lambda: provider.fetch(batch), sleep=sleep)


class StubProvider:
    """Answers with the last part of the user's text in capitals, after ``steps`` polls."""

    def __init__(self, steps: int = 1, end: str = "completed"):
        self.steps, self.end, self.batches, self.polls = steps, end, {}, {}

    def create(self, lines: list[str]) -> str:
        name = f"batch-{len(self.batches) + 1}"
        self.batches[name], self.polls[name] = list(lines), 0
        return name

    def status(self, batch: str) -> str:
        self.polls[batch] += 1
        return "in_progress" if self.polls[batch] <= self.steps else self.end

    def fetch(self, batch: str) -> list[str]:
        out = []
        for line in self.batches[batch]:
            request = json.loads(line)
            text = request["body"]["messages"][-1]["content"].split(" | ")[-1].upper()
            out.append(json.dumps({"custom_id": request["custom_id"], "response": {"body": {"choices": [{"message": {"content": text}}]}}}, ensure_ascii=False))
        return out


def submit(lines: DataFrame, column: str, make: Callable[[], Provider], size: int = 1000, poll: float = 60.0, most: float = 24 * 3600.0) -> DataFrame:
    """(line): the answers to request lines, sent from the tasks in batches of ``size``. A task that fails is run again by Spark."""

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        provider, held = make(), []
        for pdf in batches:
            held += pdf[column].dropna().tolist()
            while len(held) >= size:
                yield pd.DataFrame({"line": run_batch(provider, held[:size], poll, most)})
                held = held[size:]
        if held:
            yield pd.DataFrame({"line": run_batch(provider, held, poll, most)})

    return lines.select(column).mapInPandas(send, "line string")
