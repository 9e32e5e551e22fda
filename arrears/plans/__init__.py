"""Job compositions: the registered queries over the driver tables, their SQL oracles."""
