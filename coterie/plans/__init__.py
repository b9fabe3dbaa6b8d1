"""Named queries over the fixture tables, each with its SQL counterpart where one exists."""
