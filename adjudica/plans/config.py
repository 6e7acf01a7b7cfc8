"""Settings from the environment: the only module that knows the variables' names."""

from __future__ import annotations

import math
import os
from collections.abc import Mapping
from dataclasses import dataclass

PREFIX = "ADJUDICA_"


def number(value: str | None, fallback: float) -> float:
    """A positive finite number, else the fallback."""
    try:
        n = float(value or "")
    except ValueError:
        return fallback
    return n if math.isfinite(n) and n > 0 else fallback


@dataclass(frozen=True)
class Config:
    demo: bool  # answers come from recordings; on unless switched off or a key is there
    api_key: str  # for the provider that is made of these settings
    model: str | None  # None: the price file's default
    workbook: str
    header: str
    column: int | None  # used where no column has the header
    case_column: int
    sources: str
    state: str
    concurrency: int  # documents a task reads at once
    chunk: int
    poll_seconds: float
    retry_attempts: int
    retry_max_s: float
    max_document_mb: int
    texts: str | None  # table of (id, text, pages)
    manifest: str | None  # JSON list of more documents
    decoder: str | None  # module:function that turns a document's bytes into its text and pages
    catalogue: str | None  # JSON file of the claims' names
    provider: str | None  # module:function that makes a provider of the session and these settings
    recordings: str | None
    prices: str | None


def load(env: Mapping[str, str] = os.environ) -> Config:
    get = lambda name: env.get(PREFIX + name) or None
    whole = lambda name, fallback: int(number(get(name), fallback))
    key, demo = get("API_KEY") or "", env.get(PREFIX + "DEMO")
    demo_on = demo == "true" if demo is not None else not key
    column = number(get("COLUMN"), 0)
    return Config(
        demo=demo_on, api_key=key, model=get("MODEL"), workbook=get("WORKBOOK") or ("fixtures/caseload.xlsx" if demo_on else "cases/caseload.xlsx"), header=get("HEADER") or "Resumo Decisão",
        column=int(column) or None, case_column=whole("CASE_COLUMN", 1), sources=get("SOURCES") or ("fixtures/sources" if demo_on else "cases/documents"), state=get("STATE") or (".demo" if demo_on else "state"),
        concurrency=whole("CONCURRENCY", 2), chunk=whole("CHUNK", 100), poll_seconds=number(get("POLL_SECONDS"), 120), retry_attempts=whole("RETRY_ATTEMPTS", 20), retry_max_s=number(get("RETRY_MAX_MS"), 60_000) / 1000,
        max_document_mb=whole("MAX_DOCUMENT_MB", 120), texts=get("TEXTS"), manifest=get("MANIFEST"), decoder=get("DECODER"), catalogue=get("CATALOGUE"), provider=get("PROVIDER"), recordings=get("RECORDINGS"), prices=get("PRICES"),
    )
