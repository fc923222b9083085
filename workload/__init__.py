"""The registered queries, their SQL counterparts and the tables they run on."""
