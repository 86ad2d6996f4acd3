"""Reports and views a user asks for, and the queries registered for checking."""
