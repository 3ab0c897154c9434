"""Sources: driver tables, text and delimited files, edge lists, Kafka
payload decoders, socket text and file listings."""
