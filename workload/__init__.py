"""The driver's tables seen as telemetry, the registered queries and their SQL counterparts."""
