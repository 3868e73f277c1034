"""Interfaces to what stays outside: renderers, models, wiki clients. Each takes the callable that does the work."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from plafond.sources.files import with_model


def rendered_pages(pdfs: DataFrame, render: Callable[[bytes], list[bytes]]) -> DataFrame:
    """(name, content) of PDF files -> (page_name, image), pages numbered from 1."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(f"{n}_p{i:03d}", img) for n, c in zip(pdf["name"], pdf["content"]) for i, img in enumerate(render(c), 1)]
            yield pd.DataFrame(rows, columns=["page_name", "image"])

    return with_model(pdfs, run, "page_name string, image binary")


def answered(prompts: DataFrame, post: Callable[[str], tuple[int, str]]) -> DataFrame:
    """(id, prompt) -> (id, status, payload); a failed call gives status 0 and an empty payload."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for i, p in zip(pdf["id"], pdf["prompt"]):
                try:
                    out.append((i, *post(p)))
                except Exception:  # the pipeline goes on with an empty answer
                    out.append((i, 0, ""))
            yield pd.DataFrame(out, columns=["id", "status", "payload"])

    return with_model(prompts, run, "id bigint, status int, payload string")


def listed_files(titles: DataFrame, client: Callable[[str], list[tuple[str, str]]]) -> DataFrame:
    """(prefix) -> (image1_description_link, image1_url) of a wiki's files."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([x for p in pdf["prefix"] for x in client(p)], columns=["image1_description_link", "image1_url"])

    return with_model(titles, run, "image1_description_link string, image1_url string")


def row_projection(images: DataFrame, decode: Callable[[bytes], np.ndarray], dark: int = 180) -> DataFrame:
    """(id, image) -> (id, h_proj): dark pixels per row of a grey image."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            proj = [(decode(x) < dark).sum(axis=1).astype(int).tolist() for x in pdf["image"]]
            yield pd.DataFrame({"id": pdf["id"], "h_proj": proj})

    return with_model(images, run, "id bigint, h_proj array<int>")


def read_regions(crops: DataFrame, recognise: Callable[[list[bytes]], list[list[str]]], batch: int = 8) -> DataFrame:
    """(region_id, image) -> (region_id, lines): recognition in batches, results zipped to their regions."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            lines = [x for k in range(0, len(pdf), batch) for x in recognise(pdf["image"].tolist()[k : k + batch])]
            yield pd.DataFrame({"region_id": pdf["region_id"], "lines": lines})

    return with_model(crops, run, "region_id bigint, lines array<string>")
