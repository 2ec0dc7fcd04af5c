"""Descriptions of raw datasets: where each standard column comes from."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Dataset:
    """A raw dataset and the raw column behind each standard column."""

    key: str
    source_label: str
    column_map: dict[str, str]
    file_format: str = "csv"


# The key enters every review identifier and the label the
# ``source`` column, and the raw names are those of the published files.
AIRLINE_REVIEWS = Dataset(
    key="skytrax_airline_reviews",
    source_label="Skytrax User Reviews Dataset",
    column_map={
        "airline": "airline_name", "review_date": "date", "review_title": "title", "review_text": "content",
        "rating": "overall_rating", "traveler_type": "type_traveller", "route": "route", "seat_type": "cabin_flown",
        "recommended": "recommended",
    },
)
DEMO_FEEDBACK = Dataset(
    key="demo_airline_feedback",
    source_label="Demo",
    column_map={
        "airline": "airline", "review_date": "review_date", "review_text": "feedback_text", "rating": "rating",
        "route": "route",
    },
)


class Registry:
    """Known datasets by key; add your own with :meth:`register`."""

    def __init__(self, *datasets: Dataset):
        self._datasets = {d.key: d for d in datasets}

    def register(self, dataset: Dataset) -> None:
        self._datasets[dataset.key] = dataset

    def get(self, key: str) -> Dataset:
        if key not in self._datasets:
            raise ValueError(f"unknown dataset {key!r}; known: {', '.join(sorted(self._datasets))}")
        return self._datasets[key]


DATASETS = Registry(AIRLINE_REVIEWS, DEMO_FEEDBACK)
