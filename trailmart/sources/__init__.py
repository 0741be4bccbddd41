"""Where events and records come from, and the tables results go to."""
