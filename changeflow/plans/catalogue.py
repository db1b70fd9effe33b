"""All registered queries and their SQL, but those of the training-data operators."""

from . import changes, events, roundtrips, schemas, snapshots, streams

QUERIES = {**changes.QUERIES, **events.QUERIES, **roundtrips.QUERIES, **schemas.QUERIES, **snapshots.QUERIES, **streams.QUERIES}
ORACLES = {**changes.ORACLES, **events.ORACLES, **roundtrips.ORACLES, **schemas.ORACLES, **snapshots.ORACLES, **streams.ORACLES}
