"""Named queries over the project's tables, each with the SQL that checks it where SQL can."""
