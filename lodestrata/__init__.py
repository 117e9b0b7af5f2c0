"""lodestrata: a Spark engine for preparing and querying document corpora."""

from lodestrata.session import local_session, settle

__all__ = ["local_session", "settle"]
