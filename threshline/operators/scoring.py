"""Difficulty metrics of prompts by a pluggable scorer.

A scorer turns a batch of (prefix, completion) pairs into logits and labels; the metrics
are computed here, so that any causal model can stand behind it. The default scorer
needs no model: its logits are a fixed function of the text, for tests and dry runs.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Collection, Iterator, Sequence
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from threshline import schema as S
from threshline.functions import entries as E

MASKED = -100
BATCH_ROWS, BATCH_TOKENS, LEAST_BUDGET = 35, 10_000, 500


class Scorer(Protocol):
    """Made once per worker; ``logits`` may raise, the batch is then retried smaller."""

    #: Tokens that end every prompt.
    end: Sequence[int]

    def encode(self, text: str) -> list[int]: ...

    def decode(self, token: int) -> str: ...

    def logits(self, batch: np.ndarray) -> np.ndarray:
        """[rows, tokens, vocabulary] of [rows, tokens] ids, padded with 0."""
        ...


class HashScorer:
    """Bytes as tokens; the logits depend on the last three bytes by a hash."""

    vocabulary = 256
    end: Sequence[int] = ()

    def encode(self, text: str) -> list[int]:
        return list(text.encode())

    def decode(self, token: int) -> str:
        return bytes([token]).decode("latin-1")

    def logits(self, batch: np.ndarray) -> np.ndarray:
        past = batch.astype(np.uint64)
        state = past + np.uint64(1)
        for back in (1, 2):
            state[:, back:] = state[:, back:] * np.uint64(1_000_003) + past[:, :-back]
        mixed = state[..., None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(self.vocabulary, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed ^= mixed >> np.uint64(33)
        return (mixed * np.uint64(0xFF51AFD7ED558CCD) >> np.uint64(40)).astype(np.float32) / np.float32(1 << 22)


class CausalScorer:
    """Any causal language model: a tokenizer's functions, and ``forward``, which turns ids
    and their mask, both [rows, tokens], into logits of [rows, tokens, vocabulary]."""

    def __init__(self, encode: Callable[[str], list[int]], decode: Callable[[int], str], forward: Callable[[np.ndarray, np.ndarray], np.ndarray], end: Sequence[int] = (), pad: int = 0):
        self.encode, self.decode, self.forward, self.end, self.pad = encode, decode, forward, end, pad

    def logits(self, batch: np.ndarray, lengths: Sequence[int] | None = None) -> np.ndarray:
        sizes = np.asarray(lengths if lengths is not None else [batch.shape[1]] * len(batch))
        mask = np.arange(batch.shape[1]) < sizes[:, None]
        return self.forward(np.where(mask, batch, self.pad), mask.astype(np.int64))


@dataclass(frozen=True)
class OnnxScorer:
    """Makes the scorer of an exported causal model: give it, with its paths, as ``make_scorer``.

    The model's inputs are ``input_ids`` and ``attention_mask``, its first output the logits;
    ``end`` names the tokenizer's closing token.
    """

    model: str
    tokenizer: str
    end: str | None = None
    providers: tuple[str, ...] = ("CPUExecutionProvider",)

    def __call__(self) -> CausalScorer:
        import onnxruntime
        import tokenizers

        tok = tokenizers.Tokenizer.from_file(self.tokenizer)
        session = onnxruntime.InferenceSession(self.model, providers=list(self.providers))
        wanted = {x.name for x in session.get_inputs()}

        def forward(ids: np.ndarray, mask: np.ndarray) -> np.ndarray:
            fed = {"input_ids": ids.astype(np.int64), "attention_mask": mask}
            return session.run(None, {k: v for k, v in fed.items() if k in wanted})[0]

        end = [] if self.end is None else [tok.token_to_id(self.end)]
        return CausalScorer(lambda t: tok.encode(t, add_special_tokens=False).ids, lambda i: tok.decode([i], skip_special_tokens=False), forward, end)


def delimiter_ids(scorer: Scorer) -> frozenset[int]:
    """The tokens that encode the block delimiters."""
    return frozenset(i for d in S.BLOCK_DELIMITERS for i in scorer.encode(d))


def difficulty_metrics(logits: np.ndarray, labels: np.ndarray, decode: Callable[[int], str], delimiters: Collection[int] = ()) -> list[dict]:
    """Per row: difficulty, mean and worst loss, and the token with the worst one.

    ``labels`` hold ``MASKED`` where a token is not judged; logits at t foretell token t + 1.
    A token counts fully where the text branches (the first judged one, or right after a
    judged one of ``delimiters``), else half. Its value is 1 - (p of the right token - p of the best wrong one).
    """
    out = []
    for scores, row in zip(logits[:, :-1].astype(np.float64), labels[:, 1:], strict=True):
        at = np.flatnonzero(row != MASKED)
        if not len(at):
            out.append(_empty())
            continue
        right = row[at].astype(int)
        x = scores[at] - scores[at].max(axis=1, keepdims=True)
        logp = x - np.log(np.exp(x).sum(axis=1, keepdims=True))
        n = np.arange(len(at))
        loss = -logp[n, right]
        wrong = logp.copy()
        wrong[n, right] = -np.inf
        value = 1 - (np.exp(logp[n, right]) - np.exp(wrong.max(axis=1)))
        opens = np.isin(right[:-1], list(delimiters)) & (np.diff(at) == 1)
        branch = np.concatenate([[True], opens])
        weight = np.where(branch, 1.0, 0.5)
        average = (value * weight).sum() / max(1.0, weight.sum())
        worst_value = min(10.0, float((value * weight)[branch].max()))
        k = int(loss.argmax())
        guess = int(scores[at[k]].argmax())
        token = {"position": int(at[k]), "token_id": int(right[k]), "decoded_value": decode(int(right[k])), "loss": float(loss[k]), "pred_token_id": guess, "pred_decoded_value": decode(guess)}
        out.append({"completion_difficulty": float(0.5 * average + 0.5 * worst_value), "mean_loss": float(loss.mean()), "worst_loss": float(loss.max()), "critical_token": token})
    return out


def _empty() -> dict:
    token = {"position": -1, "token_id": -1, "decoded_value": "", "loss": 0.0, "pred_token_id": -1, "pred_decoded_value": ""}
    return {"completion_difficulty": 0.0, "mean_loss": 0.0, "worst_loss": 0.0, "critical_token": token}


def plan_batches(lengths: Sequence[int], budget: int, rows: int | None = None) -> list[list[int]]:
    """Positions by batch: by length, cut where longest x rows would pass the budget."""
    out: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: (lengths[i], i)):
        full = out and ((len(out[-1]) + 1) * lengths[i] > budget or (rows and len(out[-1]) >= rows))
        if not out or full:
            out.append([])
        out[-1].append(i)
    return out


def score_pairs(scorer: Scorer, pairs: Sequence[tuple[str, str]], budget: int = BATCH_TOKENS, rows: int | None = None) -> list[dict | None]:
    """Metrics of (prefix, prompt) pairs: the prompt's tokens after as many as its prefix
    has are judged. A prefix that leaves less than two tokens gives way to the prompt up to
    its last ``="``, if that leaves more. A batch that fails is tried once more in batches of
    half the budget; what fails below ``LEAST_BUDGET`` stays unscored."""
    coded = [_split(scorer, prefix, prompt) for prefix, prompt in pairs]
    opens = delimiter_ids(scorer)
    out: list[dict | None] = [None] * len(pairs)
    for members in plan_batches([len(p) + len(c) for p, c in coded], budget, rows):
        halves = [members]
        try:
            found = _score_batch(scorer, [coded[i] for i in members], opens)
        except (MemoryError, RuntimeError):
            if budget // 2 < LEAST_BUDGET:
                continue
            lengths = [len(coded[i][0]) + len(coded[i][1]) for i in members]
            halves = [[members[j] for j in part] for part in plan_batches(lengths, budget // 2, rows)]
            found = [m for part in halves for m in _score_batch(scorer, [coded[i] for i in part], opens)]
        for i, m in zip([i for part in halves for i in part], found, strict=True):
            out[i] = m
    return out


def _split(scorer: Scorer, prefix: str, prompt: str) -> tuple[list[int], list[int]]:
    """A prompt's tokens, cut where judging begins."""
    ids = [*scorer.encode(prompt), *scorer.end]
    n = min(len(scorer.encode(prefix)), len(ids))
    if n >= len(ids) - 1 and '="' in prompt:
        other = len(scorer.encode(prompt.rpartition('="')[0] + '="'))
        n = other if other < len(ids) - 1 else n
    return ids[:n], ids[n:]


def _score_batch(scorer: Scorer, coded: list[tuple[list[int], list[int]]], delimiters: Collection[int]) -> list[dict]:
    width = max(2, max(len(p) + len(c) for p, c in coded))
    ids, labels = np.zeros((len(coded), width), np.int64), np.full((len(coded), width), MASKED, np.int64)
    for i, (p, c) in enumerate(coded):
        ids[i, : len(p) + len(c)] = [*p, *c]
        labels[i, len(p) : len(p) + len(c)] = c
    sizes = [len(p) + len(c) for p, c in coded]
    logits = scorer.logits(ids, sizes) if isinstance(scorer, CausalScorer) else scorer.logits(ids)
    return difficulty_metrics(logits, labels, scorer.decode, delimiters)


def score(entries: DataFrame, make_scorer: Callable[[], Scorer] = HashScorer, budget: int = BATCH_TOKENS, rows: int | None = None) -> DataFrame:
    """``entries`` with loss_metrics of what follows the target's ``attr="``. The scorer is made once
    per worker; batches are planned within each Arrow batch, and order is kept."""
    plain = entries.drop("loss_metrics")
    start = E.prefix(F.col("prompt"), F.coalesce("target.attr", F.lit("")))
    split = plain.withColumns({"_prefix": F.coalesce(start, F.lit("")), "_whole": F.coalesce(F.col("prompt"), F.lit(""))})
    schema = T.StructType([*plain.schema.fields, T.StructField("loss_metrics", S.LOSS_METRICS)])
    kind = to_arrow_schema(T.StructType([T.StructField("m", S.LOSS_METRICS)])).field(0).type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = make_scorer()
        for b in batches:
            n = b.num_columns
            pairs = list(zip(b.column(n - 2).to_pylist(), b.column(n - 1).to_pylist(), strict=True))
            found = score_pairs(scorer, pairs, budget, rows)
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.array(found, kind)], names=schema.names)

    return split.mapInArrow(run, schema).select(*entries.columns)


def score_prompts(prompts: DataFrame, prompt: str = "prompt", **options) -> DataFrame:
    """Prompts without targets: what follows their last ``="`` is judged."""
    rows = prompts.withColumns({"target": F.lit(None).cast(S.TARGET), "loss_metrics": F.lit(None).cast(S.LOSS_METRICS)})
    return score(rows.withColumnRenamed(prompt, "prompt"), **options)


def benchmark_budgets(prompts: Sequence[str], budgets: Sequence[int], scorer: Scorer) -> list[dict]:
    """Per token budget: status, seconds, tokens (longest x rows, summed) and tokens a
    second. Prompts are a bounded sample on the driver; the best is ``best_budget``."""
    out = []
    for budget in budgets:
        lengths = [len(scorer.encode(p)) for p in prompts]
        plan = plan_batches(lengths, budget)
        tokens = sum(max(lengths[i] for i in b) * len(b) for b in plan)
        began, status = time.perf_counter(), "ok"
        try:
            score_pairs(scorer, [("", p) for p in prompts], budget)
        except MemoryError:
            status = "oom"
        except Exception:  # a scorer's own errors are a result here
            status = "error"
        seconds = time.perf_counter() - began
        out.append({"budget": budget, "status": status, "seconds": seconds, "tokens": tokens, "tokens_per_second": tokens / seconds if seconds else 0.0})
    return out


def best_budget(found: Sequence[dict]) -> int | None:
    good = [r for r in found if r["status"] == "ok"]
    return max(good, key=lambda r: r["tokens_per_second"])["budget"] if good else None

