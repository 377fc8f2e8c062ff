"""DataFrame operators over events, rollups, audits and metric samples."""
