"""Plans over the driver tables: registered queries and their SQL oracles."""
