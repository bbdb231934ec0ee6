"""Imports every query module so each registers itself."""

from tidemark.plans import (q_dataset, q_ingest, q_models, q_news, q_report,  # noqa: F401
                            q_stock, q_storage, q_streaming)
