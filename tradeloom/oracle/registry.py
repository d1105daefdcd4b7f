"""Complete oracle statements by registered query name."""

from __future__ import annotations

from tradeloom.oracle.bridge_sql import CTES, with_bridge
from tradeloom.oracle.jobs_sql import EXTRA_CTES, JOB_SQL, LOADED_CTES
from tradeloom.oracle.models_sql import MODEL_SQL


def oracle_statements() -> dict[str, str]:
    return {
        name: with_bridge(
            body, EXTRA_CTES.get(name), LOADED_CTES if name == "synth_load" else CTES
        )
        for name, body in {**MODEL_SQL, **JOB_SQL}.items()
    }
