"""Writers: keyed upsert, JDBC, search documents, wide-column cells."""
