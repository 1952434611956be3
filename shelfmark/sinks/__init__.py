"""Where tables of the catalogue can be published besides the store."""
