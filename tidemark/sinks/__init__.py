"""Writers: files, object stores, warehouse tables."""
