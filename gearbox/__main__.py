from gearbox.plans.cli import main

raise SystemExit(main())
