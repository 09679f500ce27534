"""Named query plans over the driver's tables and their SQL oracles."""
